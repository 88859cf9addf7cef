"""The catalogue of registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risklake.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query; ``sql`` gives the same rows on the same tables in another engine."""

    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(prepare(spark), sf_dir)

        run.__doc__ = query.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return query

    return add


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Floating sums differ in their last bits with the order of addition."""
    return df.withColumns({n: F.round(n, digits) for n in names})
