"""Registered queries on the driver's test tables, each with a DuckDB oracle.

Each module adds entries with :func:`tidyline.plans.registry.register`.
"""
