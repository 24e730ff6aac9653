"""Register of named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.plans.ordered import with_ordinal
from pulsegrid.session import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is what DuckDB runs on the same tables."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def in_order(df: DataFrame, order: list) -> DataFrame:
    """Sort, and number the rows by where they really lie after the sort.

    ``place`` comes from partition and row, not from a window over the order, so a wrong sort
    shows. A sorted result has consecutive ranges in consecutive partitions.
    """
    laid = stored(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    return with_ordinal(laid, [], ["_at"], "place").drop("_at")


def r6(column: Column | str, digits: int = 6) -> Column:
    """Computed doubles are compared at six digits; negative zero becomes zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), digits) + F.lit(0.0)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    for name in names:
        df = df.withColumn(name, r6(name, digits))
    return df
