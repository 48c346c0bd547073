"""Training-data operators: decontamination, privacy, de-duplication, filtering, sharding, packing."""
