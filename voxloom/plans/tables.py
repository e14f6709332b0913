"""Reading the test tables, and the registries that queries and their SQL enter."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import ship

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Registry:
    """Named queries with, where SQL can express them, an equivalent statement."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            @wraps(f)
            def shipped(spark: SparkSession, folder: str) -> DataFrame:
                ship(spark)
                return f(spark, folder)

            self.queries[name] = shipped
            if sql is not None:
                self.sql[name] = sql
            return f

        return add
