"""Registered queries, their DuckDB oracle SQL, and physical-plan checks."""
