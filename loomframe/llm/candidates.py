"""From rows that share a key to verified links between texts, without listing all pairs of a key's rows.

A method (pigeonhole blocks of sketches, bands of signatures) gives every text a number of keys, such that close texts
share one, or several. Keys of few rows are cheap to count: pairs that share enough of them are verified. For the
others, links are needed only as far as they join components, so a key's rows are first compared with the
smallest of them alone. Where a key still holds rows of several components, its rows are compared in square tiles
of bounded size, across components only, by a short payload; what passes is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.common import components, small_batches
from loomframe.llm.words import binary_parts, shingle_sets, sliced, texts_of
from loomframe.session import drop_written, materialise

#: Bits of a filter of ids or keys: 1,024 rows of 4 KB at most, whatever the table's size. A filter that is full
#: lets everything through to the join behind it.
FILTER_BITS = 1 << 25
#: Rows on a side of a tile.
TILE = 256
#: Classes of keys by their rows, each of twice as many as the one before.
CLASSES = 5
#: Rows of a key whose pairs are counted.
FEW = 16

Close = Callable[[list[bytes], list[bytes], np.ndarray, np.ndarray], np.ndarray]


def filtered(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key is in ``wanted`` (one column of the same name), and a few others, without a shuffle of ``rows``."""
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)) + 1
    marks = wanted.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))
    hit = rows.withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number("_slot"))
    hit = hit.join(F.broadcast(marks), "_bucket")
    place = F.bitmap_bit_position(F.col("_slot")).cast("int")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_place div 8 as int) + 1, 1)")), 16, 10).cast("int")
    on = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(F.col("_place"), F.lit(8)))), F.lit(2)) == 1
    return hit.withColumn("_place", place).where(on).drop("_slot", "_bucket", "_bits", "_place")


class Marks:
    """A filter of keys as bits: a numpy array of ``size`` / 8 bytes, whatever the number of keys."""

    def __init__(self, wanted: DataFrame, key: str = "key", size: int = FILTER_BITS):
        self.last = np.int64(size - 1)
        slot = F.col(key).bitwiseAND(F.lit(size - 1)) + 1
        rows = wanted.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
        self.bits = np.zeros((size >> 15, 4096), np.uint8)
        for row in rows.collect():
            self.bits[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
        self.bits = self.bits.reshape(-1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys are in the filter; all that were marked, and a few others."""
        slot = keys & self.last
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def often_met(sketches: DataFrame, spare: dict[int, int], written: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(pairs, members)`` of ``sketches (id, part, keys)``: what may be linked by keys of few rows, and the rest.

    Linked ids share at least ``spare[part] + 1`` keys of a part, of 8 bytes each. A sketch leaves out keys of many rows,
    those of the most rows first, at most ``spare`` of them. If these are all that it has, h, its links still share
    ``spare + 1 - h`` keys, all of few rows. ``pairs (a, b, part)`` are those that share as many. ``members
    (key, part, id)`` are the keys of many rows that other sketches are left with: two of these sketches are either in a
    pair or share one of them, as what both have left out of the keys that they share is what one of them has.
    ``written``, the table that ``sketches`` reads, is dropped on the way.
    """
    counts = exploded(sketches).groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    counts = materialise(counts, "keys")
    repeated = Marks(counts, size=4 * FILTER_BITS)
    # Classes of keys by their rows: FEW, twice as many and so on.
    classes = [Marks(counts.where(F.col("rows") > FEW << k)) for k in range(CLASSES)]
    drop_written(counts)
    bound = np.array([spare[k] for k in range(len(spare))], np.int64)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, part, ids, row = _flat(batch)
            level = np.zeros(len(keys), np.int64)
            for marks in classes:
                level += marks.has(keys)
            most = bound[batch.column("part").to_numpy()]
            # The least level from which on no more than the spare keys are left out.
            least, left_out = np.full(len(batch), CLASSES + 1), np.zeros(len(batch), np.int64)
            for k in range(CLASSES, 0, -1):
                h = np.bincount(row[level >= k], minlength=len(batch))
                fits = (h <= most) & (least == k + 1)
                least[fits], left_out[fits] = k, h[fits]
            need = np.where(least == 1, most + 1 - left_out, 1)
            keep = repeated.has(keys) & (level < least[row])
            columns = ((keys, pa.int64()), (part, pa.int32()), (ids, pa.int64()), (need[row], pa.int32()), (level > 0, pa.bool_()))
            yield pa.record_batch([pa.array(x[keep], kind) for x, kind in columns], ["key", "part", "id", "need", "hot"])

    rows = sketches.select("part", "id", "keys").mapInArrow(_by_rows(pick), "key bigint, part int, id bigint, need int, hot boolean")
    rows = materialise(rows, "members")
    drop_written(written)
    # Rows are dealt by key as they are: partial lists of mostly single rows would take more.
    band = F.call_function("shiftleft", F.col("part").cast("bigint"), F.lit(40)) + F.col("need")
    dealt = rows.where("NOT hot").select("key", "id", band.alias("band")).repartition("key")
    ids = dealt.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("id", "band"))).alias("ids")).where(F.size("ids") > 1)
    part_of = lambda x: F.call_function("shiftright", x["band"], F.lit(40)).cast("int")
    pair = lambda a, b: F.struct(a["id"].alias("a"), b["id"].alias("b"), F.greatest(a["band"], b["band"]).alias("band"))
    other = lambda a: lambda b: (part_of(a) == part_of(b)) & (a["id"] < b["id"])
    after = lambda a, i: F.transform(F.filter(F.slice("ids", i + 2, F.size("ids")), other(a)), lambda b: pair(a, b))
    pairs = ids.select(F.explode(F.flatten(F.transform("ids", after))).alias("pair"))
    pairs = pairs.select("pair.a", "pair.b", "pair.band").repartition("a", "b")
    part = F.call_function("shiftright", F.col("band"), F.lit(40)).cast("int")
    met = pairs.groupBy("a", "b", part.alias("part")).agg(F.count(F.lit(1)).alias("keys"), F.max("band").alias("band"))
    need = F.col("band") - F.call_function("shiftleft", F.col("part").cast("bigint"), F.lit(40))
    met = met.where(F.col("keys") >= need).groupBy("a", "b").agg(F.min("part").alias("part"))
    return materialise(met, "often"), rows.where("hot").select("key", "part", "id")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(key, part, id, row)`` of each key of a batch's sketches."""
    data, offsets = binary_parts(batch.column("keys"))
    keys = data.view(np.int64) if len(data) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(batch)), np.diff(offsets) // 8)
    return keys, batch.column("part").to_numpy()[row], batch.column("id").to_numpy()[row], row


def _by_rows(fn):
    return lambda batches: fn(sliced(batches, 256))


def exploded(sketches: DataFrame) -> DataFrame:
    """``(key, part, id)``: a row for each key of each sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, part, ids, _ = _flat(batch)
            yield pa.record_batch([pa.array(keys), pa.array(part, pa.int32()), pa.array(ids)], ["key", "part", "id"])

    return sketches.select("part", "id", "keys").mapInArrow(_by_rows(run), "key bigint, part int, id bigint")


def verified(docs: DataFrame, pairs: DataFrame, words: int, numerator: int, denominator: int, id_col: str, text_col: str) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` whose shingle sets share at least numerator / denominator of their union.

    Only texts that are in some pair are cut into shingles again; a set travels to each pair that names it.
    """
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [s.tobytes() for s in shingle_sets(*binary_parts(batch.column("text")), words)]
            yield pa.record_batch([batch.column("id"), pa.array(sets, pa.binary())], ["id", "items"])

    with small_batches(docs.sparkSession):
        sets = materialise(filtered(texts_of(docs, id_col, text_col), "id", ids).mapInArrow(cut, "id bigint, items binary"), "sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                left, right = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(denominator * both >= numerator * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x")).dropDuplicates(["a"])
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y")).dropDuplicates(["b"])
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    with small_batches(docs.sparkSession):
        links = materialise(both.mapInArrow(compare, "a bigint, b bigint"), "links")
    drop_written(sets)
    return links


def _tiles(close: Close):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            for row in batch.to_pylist():
                x, y = row["x"], row["y"]
                ids = [np.array([r["id"] for r in side], np.int64) for side in (x, y)]
                parts = [np.array([r["component"] for r in side], np.int64) for side in (x, y)]
                sizes = [np.array([r["n"] for r in side], np.int64) for side in (x, y)]
                good = close([bytes(r["payload"]) for r in x], [bytes(r["payload"]) for r in y], *sizes)
                good &= parts[0][:, None] != parts[1][None, :]
                a, b = np.nonzero(good)
                a, b = ids[0][a], ids[1][b]
                yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def joined(
    keys: DataFrame, payloads: DataFrame, close: Close, verify: Callable[[DataFrame], DataFrame], pairs_too: DataFrame | None = None
) -> DataFrame:
    """``(id, component)`` of the ids that are linked: connected by verified pairs that share a key.

    ``keys`` is ``(key, part, id)``, ``payloads`` ``(id, part, n, payload)``; ``close`` tells for two lists of payloads and
    their sizes which pairs may be links, and may never miss one. ``pairs_too``: more ``(a, b, part)`` to test.
    """
    counts = keys.groupBy("key").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    counts = materialise(counts, "keys")
    members = materialise(filtered(keys, "key", counts.select("key")).join(counts, "key"), "members")

    def quick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            good = [
                bool(close([bytes(r["x"])], [bytes(r["y"])], np.array([r["nx"]]), np.array([r["ny"]]))[0, 0])
                for r in batch.select(["x", "y", "nx", "ny"]).to_pylist()
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    others = members.where("id <> pivot")
    # A pair may meet in two bands; one sketch of it is enough.
    pairs = others.select(F.col("pivot").alias("a"), F.col("id").alias("b"), "part")
    if pairs_too is not None:
        pairs = pairs.union(pairs_too.select("a", "b", "part"))
    pairs = pairs.groupBy("a", "b").agg(F.min("part").alias("part"))
    left = payloads.select("part", F.col("id").alias("a"), F.col("n").alias("nx"), F.col("payload").alias("x"))
    right = payloads.select("part", F.col("id").alias("b"), F.col("n").alias("ny"), F.col("payload").alias("y"))
    near = pairs.join(right, ["part", "b"]).join(left, ["part", "a"]).select("a", "b", "x", "y", "nx", "ny")
    near = materialise(near.mapInArrow(quick, "a bigint, b bigint").distinct(), "near")
    links = verify(near)
    labels = components(links)

    # The pivot has met all rows of its key; what is left are keys whose other rows are of several components.
    found = others.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    found = materialise(found, "found")
    mixed = found.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rest = found.join(mixed.where("low < high").select("key"), "key", "left_semi")
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / TILE)).cast("int")
    rows = rest.join(payloads, ["id", "part"]).withColumn("chunk", chunk)
    chunks = rows.groupBy("key", "chunk").agg(F.collect_list(F.struct("id", "component", "n", "payload")).alias("rows"))
    chunks = materialise(chunks, "chunks")
    x = chunks.select("key", F.col("chunk").alias("i"), F.col("rows").alias("x"))
    y = chunks.select("key", F.col("chunk").alias("j"), F.col("rows").alias("y"))
    tiles = x.join(y, "key").where("i <= j").select("x", "y")
    more = tiles.mapInArrow(_tiles(close), "a bigint, b bigint").distinct().join(near, ["a", "b"], "left_anti")
    more = materialise(more, "more")
    late = verify(more)
    out = components(links.union(late))
    for table in (counts, members, near, links, labels, found, chunks, more, late):
        drop_written(table)
    return out
