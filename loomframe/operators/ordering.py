"""Global order without a global sort in one task: ranks, running totals and exact quantiles.

All work is on one row per distinct value, so a value shared by a third of the table is a single row.
Values are range-partitioned; totals of the ranges are summed once, and the running sum inside each range is an
ordinary partitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from loomframe.session import materialise


def value_counts(df: DataFrame, column: str, **sums: Column) -> DataFrame:
    """One row per distinct value with its row count ``n`` and any further sums."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), *[F.sum(e).alias(k) for k, e in sums.items()])


def running_totals(
    df: DataFrame, key: str, totals: Sequence[str], ascending: bool = True, ranges: int | None = None
) -> DataFrame:
    """Add ``<c>_before`` and ``<c>_upto`` (exclusive and inclusive running sums in key order).

    ``df`` must hold one row per key value. It is range-partitioned into as many ranges as the session shuffles to,
    so the width follows the setting for the size of the data, and written to the shared folder once with the
    number of its range, as the range totals and the result both read it.
    """
    spark = df.sparkSession
    ranges = ranges or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(ranges, F.col(key).asc_nulls_first())
    table = materialise(ranged.withColumn("_range", F.spark_partition_id()), "running")
    direction = (lambda c: F.col(c).asc_nulls_first()) if ascending else (lambda c: F.col(c).desc_nulls_last())
    per_range = table.groupBy("_range").agg(*[F.sum(c).alias(f"_{c}") for c in totals])
    earlier = Window.orderBy(direction("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        F.col("_range"), *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}_off") for c in totals]
    )
    inside = Window.partitionBy("_range").orderBy(direction(key)).rowsBetween(Window.unboundedPreceding, 0)
    # `offsets` has one row per range, as many as shuffle partitions.
    joined = table.join(F.broadcast(offsets), "_range")
    upto = {f"{c}_upto": F.sum(c).over(inside) + F.col(f"_{c}_off") for c in totals}
    out = joined.withColumns(upto)
    out = out.withColumns({f"{c}_before": F.col(f"{c}_upto") - F.col(c) for c in totals})
    return out.drop("_range", *[f"_{c}_off" for c in totals])


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """``(value, index)``: distinct values with consecutive indices in value order."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct().withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_totals(values, column, ["one"])
    return ranked.select(column, F.col("one_before").alias("index"))


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """Exact discrete quantiles (smallest value whose cumulative share reaches p).

    Only the chosen values reach the driver.
    """
    counted = value_counts(df.filter(F.col(column).isNotNull()), column)
    ranked = running_totals(counted, column, ["n"])
    total = ranked.agg(F.sum("n").alias("total")).scalar()
    picks = [
        F.min(F.when(F.col("n_upto") >= F.greatest(F.ceil(F.lit(p) * F.col("_total")), F.lit(1)), F.col(column))).alias(
            f"q{i}"
        )
        for i, p in enumerate(probabilities)
    ]
    row = ranked.withColumn("_total", total).agg(*picks).first()
    return [row[f"q{i}"] for i in range(len(probabilities))]


def quantile_bins(df: DataFrame, column: str, out: str, buckets: int) -> DataFrame:
    """Bin number by exact quantile cut points, open at both ends."""
    inner = sorted(set(exact_quantiles(df, column, [i / buckets for i in range(1, buckets)])))
    splits = [float("-inf"), *inner, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol=out).transform(df)


def average_ranks(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, rank)`` with the average rank of tied rows."""
    ranked = running_totals(value_counts(df, column), column, ["n"])
    return ranked.select(column, "n", (F.col("n_before") + (F.col("n") + 1) / 2).alias("rank"))
