"""Registration of queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gavelspark.session import table


class Tables:
    """The tables of one data directory as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self.spark, self.dir, name)


class Registry:
    """Collects the QUERIES and ORACLE of one module."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracle: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        """Registers a function of :class:`Tables` under ``name``."""

        def keep(function):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return function(Tables(spark, sf_dir))

            run.__name__, run.__doc__ = name, function.__doc__
            self.queries[name] = run
            if sql is not None:
                self.oracle[name] = sql
            return function

        return keep
