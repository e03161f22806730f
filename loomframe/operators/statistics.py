"""Correlation and independence tests as long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.stat import ChiSquareTest, Correlation
from pyspark.sql import DataFrame, functions as F

from loomframe.functions.vectors import explode_matrix
from loomframe.operators.ordering import average_ranks


def correlation(df: DataFrame, vector: str, method: str = "pearson") -> DataFrame:
    """``(i, j, value)`` of the correlation matrix of a vector column."""
    return explode_matrix(Correlation.corr(df, vector, method).toDF("matrix"), "matrix")


def rank_correlation(df: DataFrame, first: str, second: str) -> DataFrame:
    """Spearman correlation of two scalar columns by joining average ranks of their distinct values."""
    ranks_a = average_ranks(df, first).select(first, F.col("rank").alias("_ra"))
    ranks_b = average_ranks(df, second).select(second, F.col("rank").alias("_rb"))
    pairs = df.groupBy(first, second).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    ranked = pairs.join(ranks_a, first).join(ranks_b, second)
    sums = ranked.agg(
        F.sum("_n").alias("n"),
        F.sum(F.col("_n") * F.col("_ra")).alias("a"),
        F.sum(F.col("_n") * F.col("_rb")).alias("b"),
        F.sum(F.col("_n") * F.col("_ra") * F.col("_ra")).alias("aa"),
        F.sum(F.col("_n") * F.col("_rb") * F.col("_rb")).alias("bb"),
        F.sum(F.col("_n") * F.col("_ra") * F.col("_rb")).alias("ab"),
    )
    cov = F.col("ab") - F.col("a") * F.col("b") / F.col("n")
    va, vb = F.col("aa") - F.col("a") * F.col("a") / F.col("n"), F.col("bb") - F.col("b") * F.col("b") / F.col("n")
    return sums.select((cov / F.sqrt(va * vb)).alias("correlation"))


def rank_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(i, j, value)``: Spearman correlation of all pairs of scalar columns, ties at their average rank.

    Ranks are those of distinct values, so a value that most rows share is one row; one aggregate gives all pairs.
    """
    ranked = df.select(*columns)
    for i, column in enumerate(columns):
        ranks = average_ranks(df.where(F.col(column).isNotNull()), column).select(column, F.col("rank").alias(f"_rank{i}"))
        ranked = ranked.join(ranks, column)
    pairs = [(i, j) for i in range(len(columns)) for j in range(len(columns))]
    found = ranked.agg(*[F.corr(f"_rank{i}", f"_rank{j}").alias(f"c{i}_{j}") for i, j in pairs if i < j] or [F.count(F.lit(1)).alias("n")])
    cells = [
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), (F.lit(1.0) if i == j else F.col(f"c{min(i, j)}_{max(i, j)}")).alias("value"))
        for i, j in pairs
    ]
    return found.select(F.explode(F.array(*cells)).alias("c")).select("c.i", "c.j", "c.value")


def independence(df: DataFrame, vector: str, label: str) -> DataFrame:
    """``(featureIndex, pValue, degreesOfFreedom, statistic)`` of the chi-square test per feature."""
    return ChiSquareTest.test(df, vector, label, True)
