"""Helpers that several operators share: ranges of a key, connected components."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loomframe.session import drop_written, materialise


def width(df: DataFrame, least: int = 1) -> int:
    """Partitions for work on a whole table: the session's shuffle width, two for each."""
    return max(least, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512):
    """Send at most so many rows at once to Python: whole texts and sets take kilobytes each, on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def range_number(df: DataFrame, key: str, ranges: int) -> Column:
    """The number of the range that a row's key falls into; ranges hold about as many rows each. Nulls come first.

    The cuts are ``ranges - 1`` approximate quantiles, so what the driver sees is bounded by that number.
    """
    probabilities = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, probabilities, 10000).alias("cuts")).first()["cuts"] if probabilities else None
    cuts = sorted(set(found or []))
    if not cuts:
        return F.lit(0)
    literals = F.array(*[F.lit(c) for c in cuts])
    return F.coalesce(F.size(F.filter(literals, lambda c: c <= F.col(key))), F.lit(0))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(id, component)`` of every vertex of ``links (a, b)``: the smallest id it reaches.

    Each round hands every vertex the smallest label among its neighbours and then follows that label one step
    further, so the paths that are left halve at least. Labels are written to the shared folder after each
    round; vertices and links stay in Spark.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialise(both.where("a <> b").distinct(), "edges")
    labels = materialise(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    for _ in range(rounds):
        near = edges.join(labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, "a").select("a", "label", F.least("label", "near").alias("low"))
        step = labels.select(F.col("a").alias("low"), F.col("label").alias("further"))
        moved = lower.join(step, "low", "left").select("a", F.col("label").alias("old"), F.least("low", "further").alias("label"))
        moved = materialise(moved, "labels")
        drop_written(labels)
        labels = moved.select("a", "label")
        if moved.where("old <> label").isEmpty():
            drop_written(edges)
            return labels.select(F.col("a").alias("id"), F.col("label").alias("component"))
    raise RuntimeError(f"components were not done after {rounds} rounds")
