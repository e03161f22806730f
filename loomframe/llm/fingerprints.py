"""MinHash fingerprints of texts, and near duplicates by them.

A fingerprint is the least value of each of 128 universal hash permutations over a text's five-word shingles; the
share of equal places estimates the Jaccard similarity of two texts' shingle sets, with a standard error of 0.045 at
most. Near duplicates are texts that agree on a band of the fingerprint (joined in Spark) and whose sets, compared
whole, are similar enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from loomframe.llm.candidates import joined, verified
from loomframe.llm.common import range_number, width
from loomframe.llm.words import binary_parts, joined_parts, shingle_hashes, shingle_sets, sliced, texts_of, word_hashes
from loomframe.session import materialise

PLACES = 128
#: 32 bands of 4 places: a pair of similarity 0.8 shares none of them once in 20 million.
BANDS = 32
WORDS = 5
NOTHING = np.uint32(0xFFFFFFFF)

_draw = np.random.Generator(np.random.PCG64(20240608))
_FACTOR = _draw.integers(1, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SUMMAND = _draw.integers(0, 1 << 63, PLACES, dtype=np.uint64)


def signatures(data: np.ndarray, offsets: np.ndarray, words: int = WORDS, block: int = 1 << 14) -> np.ndarray:
    """One row of 128 places per text; all places of a text without words are the largest value."""
    values, sizes = shingle_hashes(*word_hashes(data, offsets), words)
    out = np.full((PLACES, len(sizes)), NOTHING, np.uint32)
    texts = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[texts])
    at = 0
    while at < len(texts):
        low = int(ends[at] - sizes[texts[at]])
        to = max(at + 1, int(np.searchsorted(ends, low + block, "right")))
        part = values[low : ends[to - 1]]
        starts = ends[at:to] - sizes[texts[at:to]] - low
        for k in range(PLACES):
            out[k, texts[at:to]] = np.minimum.reduceat((part * _FACTOR[k] + _SUMMAND[k]) >> np.uint64(32), starts)
        at = to
    return np.ascontiguousarray(out.T)


def _hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows.astype(">u4")]


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint)`` of every row. Texts without words, null ones among them, share one fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = signatures(*binary_parts(batch.column("text")), words)
            yield pa.record_batch([batch.column("id"), pa.array(_hex(found))], ["id", "fingerprint"])

    return texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long")).mapInArrow(run, "id bigint, fingerprint string")


EDITED = (
    "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order, then, marked, the first row behind the range: each but that one goes out once."""
    held = None  # key, text, signature of the row before
    for whole in batches:
        for at in range(0, len(whole), 512):
            batch = whole.slice(at, 512)
            raw = [b or b"" for b in batch.column("text").to_pylist()]
            own = signatures(*joined_parts(raw))
            rows = list(zip(batch.column("id").to_pylist(), (b.decode("utf-8", "replace") for b in raw), own, batch.column("ahead").to_pylist()))
            done = []
            for row in rows:
                if held is not None and not held[3]:
                    half = len(held[1]) // 2
                    edited = held[1][: len(held[1]) - half] + row[1][:half]
                    done.append((held, edited.encode(), row[2]))
                held = row
            if not done:
                continue
            edited = signatures(*joined_parts([e for _, e, _ in done]))
            mine = np.array([h[2] for h, _, _ in done])
            after = np.array([n for _, _, n in done])
            yield pa.record_batch(
                [
                    pa.array([h[0] for h, _, _ in done], pa.int64()),
                    pa.array([len(h[1]) for h, _, _ in done], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for _, e, _ in done]),
                    pa.array(_hex(mine)),
                    pa.array(_hex(edited)),
                    pa.array((mine == edited).mean(axis=1)),
                    pa.array((mine == after).mean(axis=1)),
                ],
                [f.split()[0] for f in EDITED.split(", ")],
            )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of an edited form: its last half replaced by the next text's beginning.

    The next text is that of the next id (null first, equal ids by text); after the last comes the first. Rows are
    dealt by ranges of the id, and the first row of each range is given to the range before as well, so texts are
    shuffled once. Null texts are empty; two texts without words have likeness 1.
    """
    parts = width(docs)
    rows = texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    cut = range_number(docs.select(F.col(id_col).cast("long").alias("id")), "id", parts)
    rows = rows.withColumn("range", cut).withColumn("h", F.xxhash64("text"))
    firsts = rows.groupBy("range").agg(F.min_by(F.struct("id", "h"), F.struct(F.col("id").isNotNull(), "id", "h")).alias("first"), F.max("id").alias("m"))
    order = Window.orderBy("range")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("range").over(order), F.last("range").over(everything))
    # One row per range, as many as twice the shuffle width.
    heads = F.broadcast(firsts.select(before.alias("to"), F.col("first.id").alias("hid"), F.col("first.h").alias("hh")))
    ahead = rows.join(heads, rows["id"].eqNullSafe(F.col("hid")) & (rows["h"] == F.col("hh")))
    ahead = ahead.groupBy("to").agg(F.first(F.struct("id", "text", "h")).alias("row")).select("row.id", "row.text", F.col("to").alias("range"), "row.h", F.lit(True).alias("ahead"))
    both = rows.withColumn("ahead", F.lit(False)).unionByName(ahead).repartition(parts, "range")
    both = both.sortWithinPartitions("range", "ahead", F.col("id").asc_nulls_first(), "h")
    return both.select("id", "text", "ahead").mapInArrow(_with_next, EDITED)


def near_duplicates(
    docs: DataFrame, words: int = WORDS, numerator: int = 4, denominator: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, component)`` of every row: the smallest id it reaches by pairs that share a band and are similar enough.

    Texts of equal shingle sets are one class, and only its first is compared. Texts without words link with nothing,
    nor do rows whose id is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            data, offsets = binary_parts(batch.column("text"))
            digests = [hashlib.sha256(s.tobytes()).digest()[:16] for s in shingle_sets(data, offsets, words)]
            yield pa.record_batch([batch.column("id"), pa.array(_hex(signatures(data, offsets, words))), pa.array(digests, pa.binary())], ["id", "fingerprint", "digest"])

    rows = texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    prints = materialise(rows.mapInArrow(run, "id bigint, fingerprint string, digest binary"), "prints")
    some = prints.where((F.col("fingerprint") != "f" * (8 * PLACES)) & F.col("id").isNotNull())
    classes = materialise(some.groupBy("fingerprint", "digest").agg(F.min("id").alias("rep")), "classes")
    size = 8 * PLACES // BANDS
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(F.col("fingerprint"), i * size + 1, F.lit(size))))
    keys = classes.select(F.explode(band).alias("key"), F.lit(0).alias("part"), F.col("rep").alias("id"))
    payloads = classes.select(F.col("rep").alias("id"), F.lit(0).alias("part"), F.lit(0).cast("long").alias("n"), F.lit(b"").alias("payload"))

    def all_close(x, y, nx, ny):
        return np.ones((len(x), len(y)), bool)

    linked = joined(keys, payloads, all_close, lambda pairs: verified(docs, pairs, words, numerator, denominator, id_col, text_col))
    to = classes.join(linked.withColumnRenamed("id", "rep"), "rep", "left")
    to = to.select("fingerprint", "digest", F.coalesce("component", "rep").alias("component"))
    out = prints.join(to, ["fingerprint", "digest"], "left")
    return out.select("id", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
