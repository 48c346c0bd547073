"""functions of the comparative-genomics analytics library."""
