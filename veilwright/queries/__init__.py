"""Queries of the core over the driver's tables, and their SQL."""
