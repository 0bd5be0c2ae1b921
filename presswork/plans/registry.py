"""Registration of queries together with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries of one module, by name."""

    def __init__(self):
        self.found: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(f: Query) -> Query:
            self.found[name] = f
            if sql:
                self.sql[name] = sql
            return f

        return register

    def queries(self) -> dict[str, Query]:
        return dict(self.found)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self.sql)
