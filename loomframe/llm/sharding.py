"""Shuffled shards of a table, by a two-pass external shuffle.

First pass: seeded hashes of key and text scatter the rows of a shard uniformly into buckets that fit in a task's memory;
a shard is a whole number of buckets. Second pass: each bucket is put in key order and then shuffled by Fisher and
Yates' method with a seed of its own, so that reruns and recomputed tasks agree, and the shards are written. Places in a
bucket become slots when the files are read: the sizes of the buckets are counted in them.

The shard of a row depends on its key and the number of shards alone: of one hash per shard the largest wins. With
one shard more, rows only move into the new one. Nulls are a key of their own. Rows of one key are spread over the
buckets of its shard by their texts; rows that are equal in both and fill more than a bucket are dealt to several by
their places in the table, where nothing tells them apart. A null text counts as one byte, like an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from loomframe.session import scratch_path

SEED = 97
#: Bytes of text in a bucket, about; a task holds a few times as much.
BUCKET_BYTES = 24 << 20


def shard_of(key: str | Column, shards: int, seed: int = SEED) -> Column:
    """The shard of a key: the one with the largest hash of (key, shard)."""
    key = F.col(key) if isinstance(key, str) else key
    key = F.coalesce(key.cast("string"), F.lit("\0"))
    drawn = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(shards)]
    return F.greatest(*drawn)["i"] if shards > 1 else F.lit(0)


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of the text, none for null, plus 1."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")


def _shuffled(seed: int):
    def shuffle(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come bucket by bucket, in key order; each bucket goes out in random order, with its rows' places."""
        held: list[pa.Table] = []

        def flush():
            bucket = pa.concat_tables(held)
            order = np.random.Generator(np.random.PCG64([seed, bucket["_bucket"][0].as_py()])).permutation(bucket.num_rows)
            for at in range(0, len(order), 4096):
                rows = bucket.take(pa.array(order[at : at + 4096]))
                place = pa.array(np.arange(at, at + rows.num_rows), pa.int64())
                yield from rows.append_column("_place", place).combine_chunks().to_batches()

        now = None
        for batch in groups:
            buckets = batch.column("_bucket").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held and now != buckets[a]:
                    yield from flush()
                    held = []
                now = buckets[a]
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held:
            yield from flush()

    return shuffle


OWN = ("shard", "slot", "_bucket", "_place")


def scattered(docs: DataFrame, shards: int, key: str, text: str, seed: int, bucket_bytes: int) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` and ``_bucket``; no bucket has much more than ``bucket_bytes``."""
    total = docs.agg(F.sum(text_bytes(text))).first()[0] or 0
    each = max(1, math.ceil(total / shards / bucket_bytes))
    content = F.xxhash64(F.lit(seed + 1), F.coalesce(F.col(key).cast("string"), F.lit("\0")), F.coalesce(F.col(text), F.lit("")))
    heavy = docs.groupBy(content.alias("_content")).agg(F.sum(text_bytes(text)).alias("_bytes"), F.count(F.lit(1)).alias("_n"))
    heavy = heavy.where((F.col("_bytes") > bucket_bytes) & (F.col("_n") > 1))
    # One row per content that fills a bucket by itself: fewer than buckets.
    heavy = heavy.select("_content", F.ceil(F.col("_bytes") / bucket_bytes).alias("_copies"))
    rows = docs.drop(*OWN, "_content", "_copies").withColumn("shard", shard_of(key, shards, seed)).withColumn("_content", content)
    rows = rows.withColumn("_nth", F.monotonically_increasing_id()).join(F.broadcast(heavy), "_content", "left")
    copy = F.coalesce(F.pmod(F.col("_nth"), F.col("_copies")), F.lit(0))
    # Copies of one content go round the buckets, so that no two large shares of it meet.
    within = F.pmod(F.col("_content") + copy, F.lit(each))
    return rows.withColumn("_bucket", F.col("shard").cast("long") * F.lit(each) + within).drop("_content", "_nth", "_copies")


def write_shards(
    docs: DataFrame, shards: int, path: str, key: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> T.StructType:
    """Shuffle and write to one folder per shard; the schema of what was written."""
    rows = scattered(docs, shards, key, text, seed, bucket_bytes)
    order = ["_bucket", F.col(key).cast("string"), F.xxhash64(text)]
    ordered = rows.repartition("_bucket").sortWithinPartitions(*order)
    schema = T.StructType([*ordered.schema.fields, T.StructField("_place", T.LongType())])
    ordered.mapInArrow(_shuffled(seed), schema).write.partitionBy("shard").parquet(path)
    return schema


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard)."""
    rows = spark.read.schema(schema).parquet(path)
    counts = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    # A row per bucket; the planner cannot know how few they are and would shuffle all rows to meet them.
    found = rows.join(F.broadcast(before), "_bucket").withColumn("slot", F.col("_before") + F.col("_place"))
    return found.drop("_bucket", "_before", "_place")


def shard_files(docs: DataFrame, shards: int, **options) -> DataFrame:
    """Shuffle, write to the shared folder, and read the files back.

    Columns named like those that are added are replaced by them. An empty table stays empty.
    """
    path = scratch_path(docs.sparkSession, "shards")
    return read_shards(docs.sparkSession, path, write_shards(docs, shards, path, **options))
