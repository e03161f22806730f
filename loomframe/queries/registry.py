"""Every query with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomframe.session import balanced

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its independent form."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def wide(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Chosen columns of a table for work that is heavy per row."""
    return balanced(table(spark, sf, name).select(*columns))


def violations(scored: DataFrame, broken: Column, holds: Column | None = None) -> DataFrame:
    """``(rows_scored, violations)``: how many rows were scored and how many break a defining property.

    ``holds`` is an aggregate over the scored rows, found in the same pass; all of them are violations unless it is true.
    """
    wrong = F.sum(F.coalesce(broken, F.lit(True)).cast("int"))
    if holds is not None:
        wrong = F.when(F.coalesce(holds, F.lit(False)), wrong).otherwise(F.count(F.lit(1)))
    return scored.agg(F.count(F.lit(1)).alias("rows_scored"), F.coalesce(wrong, F.lit(0)).cast("bigint").alias("violations"))


def none_broken(source: str, rows: str = "count(*)") -> str:
    """The SQL form of :func:`violations`: all rows scored, none broken."""
    return f"SELECT CAST({rows} AS BIGINT) AS rows_scored, CAST(0 AS BIGINT) AS violations FROM {source}"


def far(left: Column, right: Column, tolerance: float = 1e-6) -> Column:
    """Whether two numbers differ by more than a mixed absolute and relative tolerance."""
    return F.abs(left - right) > tolerance * (F.lit(1.0) + F.abs(right))


def r6(column, digits: int = 6) -> Column:
    """Round and drop the sign of zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits) + F.lit(0.0)
