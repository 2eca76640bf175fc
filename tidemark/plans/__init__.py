"""Composed tables: the case view over order data and the report tables."""
