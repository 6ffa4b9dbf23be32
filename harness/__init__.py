"""Queries and expected results over the driver tables."""
