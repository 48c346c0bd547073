"""Comparative set, graph and sequence analytics as composable DataFrame operators."""
