"""Registered queries, their input views and their DuckDB counterparts."""
