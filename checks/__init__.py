"""Queries that exercise the library on the driver tables, each with the same result in SQL."""
