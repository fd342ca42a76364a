"""Named queries with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def add(f: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"two queries named {name}")
            self.queries[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return add
