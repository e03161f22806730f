"""Joining texts by the Jaccard similarity of their word shingles: a parity-sketch join.

Every shingle of a set flips one bit of a sketch, so the bits in which two sketches differ are at most the shingles
that only one of the sets has. Sizes fall into bands; for the largest sizes of a band the similarity allows some
number d of such shingles, and the band's sketches are cut into more than d blocks of 64 bits: linked sets agree on all
blocks but d (the pigeonhole), and on all bits but d; a short fold of the sketches shows most pairs that are not links
before their sets are compared. A set joins the band above its own as well if a set there can be similar enough.

Empty blocks, and those of one shingle, agree by chance. There are more blocks than the pigeonhole needs, and a set
leaves out some, those that come first in an order of their contents, few bits before many. What two linked sets have
both left out of the blocks that they agree on is what the one that goes further has, so they meet on the blocks that
are left; as these are a few more than needed, they meet on several. Nothing is lost: each step only skips pairs that
cannot be links.

Equal sets are one class, compared once, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.candidates import filtered, joined, often_met, verified
from loomframe.llm.common import small_batches
from loomframe.llm.words import binary_parts, mix, shingle_sets, sliced, texts_of
from loomframe.session import drop_written, materialise

#: Keys are of 48 bits, which takes less to shuffle; keys that agree by chance only make pairs to test.
KEY_BITS = np.uint64((1 << 48) - 1)
#: Blocks of a sketch for each that the pigeonhole needs.
SPARE = 1.75
#: The largest size of a set, for the table of its bands.
LARGEST = 1 << 40


class Bands:
    """Bands of set sizes for a similarity, and the sketches of each."""

    def __init__(self, numerator: int, denominator: int):
        self.numerator, self.denominator = numerator, denominator
        self.ratio = max(1.25, denominator / numerator)

    def allowed(self, sizes):
        """The most shingles that only one of two linked sets can have, by the sum of their sizes."""
        return sizes * (self.denominator - self.numerator) // (self.denominator + self.numerator)

    def of(self, n: int) -> tuple[int, int, int]:
        """``(number, least, most)`` of the band of a size."""
        k, least = 0, 1
        while n >= (above := int(least * self.ratio) + 1):
            k, least = k + 1, above
        return k, least, above - 1

    def needed(self, band: tuple[int, int, int]) -> int:
        """One block more than linked sets of a band can differ in."""
        return int(self.allowed(2 * band[2])) + 1

    @staticmethod
    def extra(needed: int) -> int:
        """How many keys a set has beyond those that are needed: linked sets share that many and one."""
        return needed // 4

    def spare(self) -> dict[int, int]:
        """The same by band."""
        found, band = {}, self.of(1)
        while band[1] < LARGEST:
            found[band[0]] = self.extra(self.needed(band))
            least = band[2] + 1
            band = (band[0] + 1, least, int(least * self.ratio))
        return found

    def sketch(self, items: np.ndarray, band: tuple[int, int, int]) -> np.ndarray:
        """The blocks of a set's sketch, 64 bits each."""
        needed = self.needed(band)
        bits = 64 * max(int(SPARE * needed), needed + self.extra(needed))
        salt = np.array([band[0] + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        place = mix(items + salt) % np.uint64(bits)
        odd = (np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
        return np.packbits(odd).view(np.uint64)

    def keys(self, sketch: np.ndarray, band: tuple[int, int, int]) -> np.ndarray:
        """The join keys of a sketch: of the band, a block's number and its bits, without the first in their order."""
        number = np.arange(len(sketch), dtype=np.uint64)
        keys = mix(sketch ^ mix(np.uint64(band[0] << 32) + number))
        order = np.lexsort((keys, np.bitwise_count(sketch)))
        needed = self.needed(band)
        return keys[order[len(sketch) - needed - self.extra(needed) :]] & KEY_BITS

    @staticmethod
    def fold(sketch: np.ndarray) -> np.ndarray:
        """A small part of a sketch: every so many blocks are laid over each other by exclusive or.

        Two folds differ in no more bits than the sketches do, and still in about twice as many as linked sets may,
        if the sets are unlike.
        """
        words = -(-len(sketch) // 28)
        padded = np.zeros(-(-len(sketch) // words) * words, np.uint64)
        padded[: len(sketch)] = sketch
        return np.bitwise_xor.reduce(padded.reshape(-1, words), axis=0)

    def sketches(self, items: np.ndarray) -> Iterator[tuple[tuple[int, int, int], np.ndarray]]:
        """The band of a set and the next, if sets of other contents can be similar enough there, with its sketches."""
        band = self.of(len(items))
        if self.allowed(2 * band[2]) > 0:
            yield band, self.sketch(items, band)
        above = self.of(band[2] + 1)
        if len(items) * self.denominator >= self.numerator * above[1]:
            yield above, self.sketch(items, above)

    def close(self, x: list[bytes], y: list[bytes], nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
        """Which pairs of folds of one band's sketches differ in no more bits than linked sets may."""
        left = np.array([np.frombuffer(s, np.uint64) for s in x])
        right = np.array([np.frombuffer(s, np.uint64) for s in y])
        most = self.allowed(nx[:, None] + ny[None, :])
        good = np.abs(nx[:, None] - ny[None, :]) <= most
        differ = np.zeros(good.shape, np.int64)
        for k in range(left.shape[1]):
            differ += np.bitwise_count(left[:, None, k] ^ right[None, :, k])
        return good & (differ <= most)


def described(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, n, low, high)``: per text its set's size and a 128-bit digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = list(shingle_sets(*binary_parts(batch.column("text")), words))
            digest = lambda s: pa.array([int(mix(items + np.uint64(s)).sum(dtype=np.uint64).astype(np.int64)) for items in sets], pa.int64())
            sizes = pa.array([len(items) for items in sets], pa.int64())
            yield pa.record_batch([batch.column("id"), sizes, digest(1), digest(2)], ["id", "n", "low", "high"])

    rows = texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(run, "id bigint, n bigint, low bigint, high bigint")


def sketched(docs: DataFrame, bands: Bands, words: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, part, n, fold, keys)``: a row for each band that a text's set joins, the keys as 8 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out: list[tuple] = []
            for key, items in zip(batch.column("id").to_pylist(), shingle_sets(*binary_parts(batch.column("text")), words)):
                for band, sketch in bands.sketches(items) if len(items) else ():
                    out.append((key, band[0], len(items), bands.fold(sketch).tobytes(), bands.keys(sketch, band).tobytes()))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "part", "n", "fold", "keys"])

    rows = texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(run, "id bigint, part int, n bigint, fold binary, keys binary")


def similar_sets(
    docs: DataFrame, words: int = 5, numerator: int = 4, denominator: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, n, component)`` of every row: its set's size and the smallest id that it reaches by links.

    Texts link when denominator * shared shingles >= numerator * shingles of either. A-Z count as a-z; a text of
    fewer words than a shingle has its whole sequence as its one shingle. Null texts, empty ones and those of white
    space have size 0 and link with nothing, nor do rows whose id is null. An empty table gives an empty result.
    """
    bands = Bands(numerator, denominator)
    spark = docs.sparkSession
    with small_batches(spark):
        own = materialise(described(docs, words, id_col, text_col), "own")
    classes = own.where("n > 0 and id is not null").groupBy("low", "high", "n").agg(F.min("id").alias("rep"))
    classes = materialise(classes, "classes")
    firsts = classes.select(F.col("rep").alias("id"))
    # The filter passes a few others, whose sketches are left out by their ids. An id that several texts have joins with
    # all of their sketches, and what links is decided by whole sets.
    some = filtered(texts_of(docs, id_col, text_col).withColumn("id", F.col("id").cast("long")), "id", firsts)
    with small_batches(spark):
        every = materialise(sketched(some, bands, words, "id", "text"), "sketches")
    others = materialise(every.select("id").distinct().join(firsts, "id", "left_anti"), "others")
    sketches = every.join(others, "id", "left_anti")

    def verify(pairs: DataFrame) -> DataFrame:
        return verified(docs, pairs, words, numerator, denominator, id_col, text_col)

    folds = sketches.select("id", "part", "n", F.col("fold").alias("payload")).dropDuplicates(["id", "part"])
    folds = materialise(folds, "folds")
    pairs, members = often_met(sketches, bands.spare(), every)
    linked = joined(members, folds, bands.close, verify, pairs)
    for table in (folds, pairs, members, others):
        drop_written(table)
    to = classes.join(linked.withColumnRenamed("id", "rep"), "rep", "left")
    to = to.select("low", "high", "n", F.coalesce("component", "rep").alias("component"))
    out = own.join(to, ["low", "high", "n"], "left")
    return out.select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
