"""How a module of queries is put together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Book:
    """Queries by name, the SQL they are checked against, and the operators of the inventory that each one shows."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}
        self.covers: dict[str, str] = {}

    def add(self, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
        def put(query: Query) -> Query:
            self.queries[query.__name__] = query
            self.covers[query.__name__] = covers
            if sql is not None:
                self.oracles[query.__name__] = sql
            return query

        return put
