"""Contracts, surrogate keys and weekly metrics for order tables, as Spark jobs."""
