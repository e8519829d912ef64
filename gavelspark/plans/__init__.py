"""Registered queries: each module has QUERIES (callables) and ORACLE (SQL)."""
