"""The catalog of named queries: each entry is a callable ``(spark, sf_dir) -> DataFrame`` with an optional oracle in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Queries by name, in order of registration."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers the decorated function as query ``name``."""

        def add(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} exists")
            self.queries[name] = f
            if sql is not None:
                self.oracles[name] = sql
            return f

        return add


CORE = Catalog()
