"""Registered queries over the given tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Named queries of one area."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            key = name or query.__name__
            if key in self.queries:
                raise ValueError(f"query {key} is registered twice")
            self.queries[key] = query
            if sql is not None:
                self.oracles[key] = sql
            return query

        return register
