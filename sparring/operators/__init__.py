"""Relational and learning operators; each takes and returns DataFrames."""
