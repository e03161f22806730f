"""Isotonic regression by blocks that merge: pool-adjacent-violators over ranges, then over ranges of their blocks.

Points of equal x are one weighted point. Pooling neighbours that are out of order gives the same blocks whatever the
order of pooling, so ranges of x are pooled on their own first, and the blocks that are left in ever fewer ranges until
no two neighbours across a border are out of order. Values that rise already end after the first pass, however many.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loomframe.session import drop_written, materialise

#: How many ranges of blocks are pooled together in the next pass.
MERGED = 16
BLOCKS = "lo double, hi double, total double, weight double"


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of one range, which come in order. A block takes up its neighbours that are not below it."""
    held: list[list[float]] = []
    for batch in batches:
        for lo, hi, total, weight in zip(*[c.to_pylist() for c in batch.columns]):
            block = [lo, hi, total, weight]
            while held and held[-1][2] * block[3] >= block[2] * held[-1][3]:
                last = held.pop()
                block = [last[0], block[1], last[2] + block[2], last[3] + block[3]]
            held.append(block)
    for at in range(0, len(held), 10_000):
        columns = zip(*held[at : at + 10_000])
        yield pa.record_batch([pa.array(c, pa.float64()) for c in columns], ["lo", "hi", "total", "weight"])


def _in_order(blocks: DataFrame) -> bool:
    """Whether each range's first block is above the last one of the range before; one row per range is compared."""
    value = F.col("total") / F.col("weight")
    ends = blocks.groupBy("range").agg(F.min("lo").alias("lo"), F.min_by(value, "lo").alias("first"), F.max_by(value, "lo").alias("last"))
    before = F.lag("last").over(Window.orderBy("lo"))
    return ends.select((before >= F.col("first")).alias("wrong")).where("wrong").isEmpty()


def isotonic_blocks(rows: DataFrame, x: str, y: str, weight: str | None = None, increasing: bool = True) -> DataFrame:
    """``(lo, hi, prediction, weight)``: the blocks of the best monotone fit, those of equal predictions as one.

    Rows without x, y or a positive weight are left out, as are values that are not finite. An empty table has no blocks.
    """
    sign = 1.0 if increasing else -1.0
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = rows.select(F.col(x).cast("double").alias("lo"), (F.col(y).cast("double") * sign).alias("_y"), w.alias("weight"))
    finite = [F.abs(c) < F.lit(float("inf")) for c in ("lo", "_y", "weight")]
    points = rows.where(finite[0] & finite[1] & finite[2] & (F.col("weight") > 0)).groupBy("lo")
    points = points.agg(F.sum(F.col("_y") * F.col("weight")).alias("total"), F.sum("weight").alias("weight"))
    blocks = materialise(points.select("lo", F.col("lo").alias("hi"), "total", "weight"), "points")
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        ranged = blocks.repartitionByRange(ranges, "lo") if ranges > 1 else blocks.repartition(1)
        pooled = ranged.select("lo", "hi", "total", "weight").sortWithinPartitions("lo").mapInArrow(_pooled, BLOCKS)
        pooled = materialise(pooled.withColumn("range", F.spark_partition_id()), "blocks")
        drop_written(blocks)
        blocks = pooled
        if ranges == 1 or _in_order(blocks):
            break
        ranges = -(-ranges // MERGED)
    return blocks.select("lo", "hi", (F.lit(sign) * F.col("total") / F.col("weight")).alias("prediction"), "weight")


def boundary_rows(blocks: DataFrame) -> DataFrame:
    """``(boundary, prediction)``: both ends of every block; predictions between two rows lie on the line between them."""
    ends = F.when(F.col("lo") == F.col("hi"), F.array("lo")).otherwise(F.array("lo", "hi"))
    return blocks.select(F.explode(ends).alias("boundary"), "prediction")
