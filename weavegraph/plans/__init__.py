"""Queries on the driver's tables."""
