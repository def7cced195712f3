"""Named queries over the driver's tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..schema import naive_utc
from ..session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)``; results leave with timestamps without zone."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return naive_utc(fn(prepare(spark), sf_dir))

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return register
