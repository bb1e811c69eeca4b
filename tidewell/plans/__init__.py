"""Registered end-to-end plans (one per operator in the inventory) and their
DuckDB oracle SQL."""
