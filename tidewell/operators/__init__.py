"""Relational and statistical operators, one module per pipeline stage."""
