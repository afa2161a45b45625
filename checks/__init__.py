"""Registered queries over the given tables, and the same results as SQL."""
