"""gavelspark: a Spark-first engine for archived civic records.

Layers: ``sources`` (scans and sinks), ``functions`` (column expressions),
``operators`` (relational and temporal operators over DataFrames),
``streaming`` (change-feed operators), ``plans`` (registered queries with their
reference SQL) and the optional ``llm`` subpackage (corpus operators).  Nothing
outside ``llm`` imports ``llm``.
"""
