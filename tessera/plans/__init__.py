"""Queries that run the operators over the driver's tables."""
