"""Relational, temporal and data-quality operators over DataFrames."""
