"""Whole jobs and SQL, composed from the operators."""
