"""A quality classifier: perplexity under a Kneser-Ney model of trusted text, with a limit for each language.

The model is an interpolated modified Kneser-Ney trigram model. Its tokens are the words that trusted text repeats;
any other word is one of 32 shapes (which kinds of characters it has), and the first, second, ... eighth or later repeat
of the word before are tokens of their own: in trusted text long runs of a word do not occur. The n-grams of all training
texts are counted; probabilities are made from the counts where the n-grams of a context and those of an ending meet.

A text's log probability is a sum over its n-grams: log p(w) for every word, and for every longer n-gram that the model
knows a correction. So scoring is a count join too: documents send their n-grams to the shards of the model, which
answer with one sum per document. At most a million of the most frequent n-grams are broadcast and settled on the
spot, and a filter of fixed size keeps back n-grams that the model does not know; the larger the model, the fewer. Batches
of documents have a row for each shard that they ask, and the model is sent once, in as many shards as its size needs.

A document is kept if its perplexity is at most the given quantile of all trusted documents of its language that the
model was not trained on. Languages with few of them (null is a language as well) take the quantile of all.
Per-token log probabilities of short texts are drawn towards the language's mean by ``prior`` tokens. Texts without
words are rejected: they have no perplexity. Rows that are equal get equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from loomframe.llm.words import _hashes, binary_parts, sliced, texts_of, word_spans
from loomframe.operators.relational import lookup
from loomframe.session import drop_written, materialise

#: Shapes of unknown words are tokens 0 to 31.
BEGIN, END, REPEAT, FIRST_WORD = 32, 33, 34, 48
#: The longest run of one word that is told from longer ones: the k-th repeat is token REPEAT + k - 1.
RUN = 8
MAX_WORDS = 60_000
#: N-grams that are broadcast, 16 bytes each.
FREQUENT = 1_000_000
FILTER_BITS = 1 << 27
#: The largest prime below FILTER_BITS: keys are dealt by their remainder.
PRIME = 134_217_689
#: Keys below 2 to the 48 that agree in both remainders are equal.
OTHER = PRIME - 2
#: N-grams of a shard of the model, about, and n-grams handled at a time before they are sent.
SHARD = 1_000_000
PACK = 500_000

_KIND = np.full(256, 16, np.uint8)  # other symbols
_KIND[97:123] = _KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 4
_KIND[[33, 39, 44, 46, 58, 59, 63]] = 8


@dataclass
class Vocabulary:
    """Hashes of the known words, sorted, and their numbers."""

    hashes: np.ndarray
    numbers: np.ndarray

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(tokens of all texts, words of each text)``."""
        found, begun = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        before, run_before = None, 0
        for starts, ends in word_spans(data, offsets):
            hashes = _hashes(data, starts, ends, False)
            if not len(hashes):
                continue
            sizes = ends - starts
            first = np.cumsum(sizes) - sizes
            letters = data[np.arange(int(sizes.sum())) + np.repeat(starts - first, sizes)]
            token = np.bitwise_or.reduceat(_KIND[letters], first).astype(np.int64)
            if len(self.hashes):
                place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
                token = np.where(self.hashes[place] == hashes, self.numbers[place], token)
            same = np.zeros(len(hashes), bool)
            same[1:] = hashes[1:] == hashes[:-1]
            same[0] = hashes[0] == before
            head = np.searchsorted(starts, offsets[:-1])
            head = head[(head < len(starts)) & (np.append(offsets[:-1], 0)[:-1] >= starts[0])]
            same[head] = False
            if starts[0] in offsets[:-1]:
                same[0] = False
            at = np.arange(len(same))
            fresh = np.maximum.accumulate(np.where(same, -1, at))
            run = np.where(fresh < 0, at + 1 + run_before, at - fresh)
            before, run_before = hashes[-1], int(run[-1])
            found.append(np.where(same, REPEAT - 1 + np.minimum(run, RUN), token))
            begun.append(starts)
        return np.concatenate(found), np.diff(np.searchsorted(np.concatenate(begun), offsets))


def padded(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(tokens with two marks before each text and one behind, how many there are of each text)``."""
    sizes = counts + 3
    out = np.full(int(sizes.sum()), BEGIN, np.int64)
    ends = np.cumsum(sizes)
    out[ends - 1] = END
    inner = np.arange(len(tokens)) + np.repeat(2 + 3 * np.arange(len(counts)), counts)
    out[inner] = tokens
    return out, sizes


def keys_of(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(pairs, triples)`` that end at each token, as numbers; -1 where that would reach over a text's beginning."""
    ends = np.cumsum(sizes)
    place = np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)
    two, three = np.full(len(tokens), -1, np.int64), np.full(len(tokens), -1, np.int64)
    two[1:] = tokens[:-1] << 16 | tokens[1:]
    three[2:] = tokens[:-2] << 32 | two[2:]
    two[place < 1] = -1
    three[place < 2] = -1
    return two, three


def training_ids(labels: DataFrame, train_docs: int | None, id_col: str) -> DataFrame:
    """``(id)`` of the rows labelled good that the model learns from: half of them, by hash.

    The other half is never trained on, so there are texts to take limits from however few labels there are.
    ``train_docs`` keeps those with the least hashes; without it all are taken.
    """
    good = labels.where("quality = 1").select(F.col(id_col).alias("id")).distinct().where(F.pmod(F.xxhash64("id"), F.lit(2)) == 0)
    return good if train_docs is None else good.orderBy(F.xxhash64("id"), "id").limit(train_docs)


def trusted_sample(docs: DataFrame, labels: DataFrame, train_docs: int | None, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` of the rows that the model learns from."""
    texts = texts_of(docs, id_col, text_col).where(F.pmod(F.xxhash64(F.col("id").cast(labels.schema[id_col].dataType)), F.lit(2)) == 0)
    return lookup(texts, training_ids(labels, train_docs, id_col), "id", missing="drop")


def vocabulary(sample: DataFrame, least: int = 2, most: int = MAX_WORDS) -> Vocabulary:
    """The words that come at least so often in the sample, the most frequent ones if there are too many.

    The driver sees no more than ``most`` hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            data, offsets = binary_parts(batch.column("text"))
            hashes = [_hashes(data, s, e, False) for s, e in word_spans(data, offsets)]
            word, n = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), return_counts=True)
            yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    counts = sample.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most).collect()
    hashes = np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))
    return Vocabulary(hashes, FIRST_WORD + np.arange(len(hashes)))


@dataclass
class Model:
    """Weights of known pairs and triples: those of the most frequent ones, sorted by key, and a table of counts from which
    ``weigh`` makes all, ``size`` of them counted less than ``least``; logs of single tokens, and of the beginning's context."""

    words: Vocabulary
    single: np.ndarray
    start: float
    frequent: tuple[np.ndarray, np.ndarray]
    counts: DataFrame
    weigh: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]
    least: int
    size: int


def _discounts(counts: DataFrame) -> np.ndarray:
    """The discounts of n-grams that are counted 0, 1, 2 and 3 or more times, from the numbers of those counted up to 4 times."""
    row = counts.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n = [0, *row]
    if not n[1] or not n[2]:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n[1] / (n[1] + 2 * n[2])
    found = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2 for k in (1, 2, 3)]
    return np.array([0.0, *[min(max(d, 0.1), k - 0.05) for k, d in zip((1, 2, 3), found)]])


def _kinds(c: Column) -> list[Column]:
    """How many n-grams are counted once, twice and more often."""
    return [F.count_if(c == 1), F.count_if(c == 2), F.count_if(c > 2)]


def _left(discounts: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """What the discounts take from a context, from its three numbers of n-grams, 16 bits each."""
    return sum(d * (packed >> 16 * k & 0xFFFF) for k, d in enumerate(discounts[1:]))


def counted(sample: DataFrame, words: Vocabulary) -> DataFrame:
    """``(key, c, n, tail, c2, first, gn, gt)``: a row for each triple, and for pairs that end none.

    ``c`` is the triple's number, ``n`` packs how many of its context are counted once, twice and more often. ``tail`` is
    its last two tokens; the ``first`` row of a tail has the pair's number ``c2``, and ``gn`` and ``gt`` are the pair's
    own ``n`` and sum as a context. Triples are dealt twice, by contexts and by tails; neither has more than one
    triple for each token, however large the sample.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            c = np.bincount(at, np.concatenate([c for _, c in held])).astype(np.int64)
            return pa.record_batch([pa.array(key >> 16), pa.array(key), pa.array(c)], ["context", "key", "c"])

        for batch in sliced(batches):
            _, three = keys_of(*padded(*words.tokens(*binary_parts(batch.column("text")))))
            held.append(np.unique(three[three >= 0], return_counts=True))
            size += len(held[-1][0])
            if size >= PACK:
                yield summed()
                held, size = [], 0
        if held:
            yield summed()

    found = sample.select("text").mapInArrow(run, "context bigint, key bigint, c bigint").repartition("context")
    threes = found.groupBy("context", "key").agg(F.sum("c").alias("c"))
    context = Window.partitionBy("context")
    one, two, more = (k.over(context) for k in _kinds(F.col("c")))
    threes = threes.select(
        "context", "key", "c", F.sum("c").over(context).alias("total"),
        (one + F.shiftleft(two, 16) + F.shiftleft(more, 32)).alias("n"), F.row_number().over(context.orderBy("key")).alias("place"),
    )
    # Each context is a row of its own as well, which meets the triples that end with it.
    triple = F.struct("key", F.pmod("key", F.lit(1 << 32)).alias("tail"), "c", "n")
    own = F.struct(F.lit(None).cast("bigint").alias("key"), F.col("context").alias("tail"), F.col("total").alias("c"), "n")
    rows = threes.select(F.explode(F.when(F.col("place") == 1, F.array(triple, own)).otherwise(F.array(triple))).alias("r")).select("r.*")
    # Pairs count the different words before them; after the beginning there are none, so their own number.
    tail, is_own = Window.partitionBy("tail"), F.col("key").isNull()
    number = F.when(is_own, 0).when(F.shiftright("tail", 16) == BEGIN, F.col("c")).otherwise(1)
    first = F.row_number().over(tail.orderBy(F.desc_nulls_last("key"))) == 1
    rows = rows.select(
        "key", "tail", "c", "n", F.sum(number).over(tail).alias("c2"), first.alias("first"),
        F.max(F.when(is_own, F.col("n"))).over(tail).alias("gn"), F.max(F.when(is_own, F.col("c"))).over(tail).alias("gt"),
    ).where(F.col("first") | ~is_own)
    once = lambda name: F.when(F.col("first"), F.col(name)).alias(name)
    return rows.select("key", F.when(~is_own, F.col("c")).alias("c"), F.when(~is_own, F.col("n")).alias("n"), "tail", "c2", "first", once("gn"), once("gt"))


def _known(counts: DataFrame) -> DataFrame:
    """``(key, c)`` of all pairs and triples of the model."""
    pair = F.when(F.col("first"), F.struct(F.col("tail").alias("key"), F.col("c2").alias("c")))
    return counts.select(F.explode(F.array(F.struct("key", "c"), pair)).alias("r")).where("r.key is not null").select("r.*")


def train(sample: DataFrame, least: int = 2) -> Model:
    """Fit the model to ``(id, text)`` rows. An empty sample gives equal probabilities."""
    words = vocabulary(sample, least)
    counts = materialise(counted(sample, words), "counts")
    pairs = counts.where(F.col("first") & (F.col("c2") > 0)).select("tail", F.col("c2").alias("c"))
    last = F.pmod(F.col("tail"), F.lit(1 << 16)).cast("int")
    size = FIRST_WORD + len(words.hashes)  # the driver sees so many rows at most
    c1 = np.zeros(size, np.int64)
    for key, c in pairs.groupBy(last).agg(F.count(F.lit(1))).collect():
        c1[key] = c
    d1 = _discounts(sample.sparkSession.createDataFrame([(int(c),) for c in c1[c1 > 0]], "c bigint"))
    d2, d3 = _discounts(pairs), _discounts(counts.where("key is not null"))

    off = d1[np.minimum(c1, 3)]
    p1 = (c1 - off) / max(1, c1.sum())
    # 32 shapes, the end, the repeats and the words can follow; the beginning and the numbers left free cannot.
    can = np.ones(size, bool)
    can[[BEGIN, *range(REPEAT + RUN, FIRST_WORD)]] = False
    p1[can] += (off.sum() / c1.sum() if c1.any() else 1.0) / can.sum()
    left2, total2 = np.zeros(size), np.ones(size)
    for key, total, *kinds in pairs.groupBy(F.shiftright("tail", 16).cast("int")).agg(F.sum("c"), *_kinds(F.col("c"))).collect():
        left2[key], total2[key] = d2[1:] @ kinds, total

    def weigh(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(keys, numbers, weights)`` of the triples and pairs of a batch of counts."""
        key, c, n, tail, c2, gn, gt = (pa.compute.fill_null(batch.column(k), -1).to_numpy() for k in ("key", "c", "n", "tail", "c2", "gn", "gt"))
        before, last = tail >> 16, tail & 0xFFFF
        high2, gamma2 = (c2 - d2[np.minimum(c2, 3)]) / total2[before], left2[before] / total2[before]
        with np.errstate(divide="ignore", invalid="ignore"):
            lower = gamma2 * p1[last]
            gain3 = np.log10(1 + (c - d3[np.minimum(np.maximum(c, 0), 3)]) / (_left(d3, n) * (high2 + lower)))
            # A pair counts twice: as what a word adds to the one before, and as the context of the next word.
            weight2 = np.where(c2 > 0, np.log10(1 + high2 / lower), 0.0) + np.where(gt > 0, np.log10(_left(d3, gn) / gt), 0.0)
        three, two = key >= 0, batch.column("first").to_numpy(zero_copy_only=False)
        return np.concatenate([key[three], tail[two]]), np.concatenate([c[three], c2[two]]), np.concatenate([gain3[three], weight2[two]])

    # The most frequent n-grams are those counted at least so often that no more than FREQUENT are.
    numbers = _known(counts).groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()
    upto = np.cumsum([r["n"] for r in numbers])
    many = int(np.searchsorted(upto, FREQUENT, "right"))
    floor = numbers[many - 1]["c"] if many else (numbers[0]["c"] + 1 if numbers else 1)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, c, weight = weigh(batch)
            yield pa.record_batch([pa.array(key[c >= floor]), pa.array(weight[c >= floor])], ["key", "weight"])

    some = counts.where((F.col("c") >= floor) | (F.col("first") & (F.col("c2") >= floor)))
    best = some.mapInArrow(top, "key bigint, weight double").toArrow()
    order = np.argsort(best["key"].to_numpy())
    frequent = best["key"].to_numpy()[order], best["weight"].to_numpy()[order]
    single = np.where(p1 > 0, np.log10(np.maximum(p1, 1e-300)), 0.0)
    used = left2 > 0
    single[used] += np.log10(left2[used] / total2[used])
    start = counts.where((F.col("tail") == (BEGIN << 16 | BEGIN)) & F.col("first")).toArrow().to_batches()
    begin = sum(float(weigh(b)[2][-1]) for b in start if len(b))
    rest = int(upto[-1] - len(order)) if numbers else 0
    return Model(words, single, begin, frequent, counts, weigh, floor, rest)


def _spread(key: np.ndarray) -> np.ndarray:
    """A number below FILTER_BITS for each key."""
    return key % PRIME


def _filter(model: Model) -> np.ndarray:
    """Two bits for each key that is not among the most frequent: 16 MB whatever the model's size."""
    slots = F.array(*[F.pmod(F.col("key"), F.lit(m)) + 1 for m in (PRIME, OTHER)])
    rows = _known(model.counts).where(F.col("c") < model.least).select(F.explode(slots).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
    rows = rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows.toLocalIterator():
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


# Rows of the model have keys and weights, those of documents keys and the places of their documents in the batch; one
# row of each batch has what is settled, by document, with the documents' ids, hashes, languages and numbers of tokens.
ASKED = (
    "shard int, model boolean, batch bigint, keys array<bigint>, docs array<smallint>, weights array<double>, "
    "ids array<bigint>, hs array<bigint>, langs array<string>, ns array<bigint>"
)
ANSWERED = "batch bigint, docs array<smallint>, sums array<double>, ids array<bigint>, hs array<bigint>, langs array<string>, ns array<bigint>"
SCORED = "id bigint, h bigint, lang string, n bigint, log10_p double"


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def _table(schema: str, rows: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch of the columns that are given; the others are null."""
    kinds = {"smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}
    of = lambda k: pa.list_(kinds[k[6:-1]]) if k.startswith("array") else kinds[k]
    fields = [f.split() for f in schema.split(", ")]
    return pa.record_batch([columns[n] if n in columns else pa.nulls(rows, of(k)) for n, k in fields], [n for n, _ in fields])


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, h, lang, n, log10_p)``: the tokens (the end included) and log probability of each text; ``h`` is its hash.

    Batches of documents are numbered by their places in the scan, so ``docs`` should come from files.
    """
    words, single, start, weigh, least = model.words, model.single, model.start, model.weigh, model.least
    context = docs.sparkSession.sparkContext
    bits, frequent = context.broadcast(_filter(model)), context.broadcast(model.frequent)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(width, -(-model.size // SHARD))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in sliced(batches):
            number += 1
            tokens, sizes = padded(*words.tokens(*binary_parts(batch.column("text"))))
            two, three = keys_of(tokens, sizes)
            doc = np.repeat(np.arange(len(sizes), dtype=np.int16), sizes)
            ends = np.cumsum(sizes)
            place = np.arange(len(tokens)) - (ends - sizes)[doc]
            # Each token but the two marks is predicted once; each but the end, and the first mark, is a context.
            value = np.where(place == 0, 0.0, single[tokens])
            base = np.add.reduceat(value, ends - sizes) + start if len(sizes) else np.zeros(0)
            two[place < 2] = -1  # the pair of both marks is the constant
            keys, of = np.concatenate([two, three]), np.concatenate([doc, doc])
            real = keys >= 0
            keys, of = keys[real], of[real]
            top, gain = frequent.value
            if len(top):
                at = np.minimum(np.searchsorted(top, keys), len(top) - 1)
                settled = top[at] == keys
                base += np.bincount(of[settled], gain[at[settled]], minlength=len(base))
                keys, of = keys[~settled], of[~settled]
            for modulus in (PRIME, OTHER):
                at = keys % modulus
                hit = (bits.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                keys, of = keys[hit], of[hit]
            shard = _spread(keys) % shards
            whole = np.array([0, len(sizes)])
            settled = {
                "shard": pa.array([number % shards], pa.int32()), "model": pa.array([False]), "batch": pa.array([number]),
                "docs": _lists(np.arange(len(sizes), dtype=np.int16), whole), "weights": _lists(base, whole),
                "ns": _lists(sizes.astype(np.int64) - 2, whole),
            }
            bounds = pa.array(whole.astype(np.int32))
            settled |= {c: pa.ListArray.from_arrays(bounds, batch.column(k)) for c, k in (("ids", "id"), ("hs", "h"), ("langs", "lang"))}
            yield _table(ASKED, 1, settled)
            order = np.lexsort((keys, shard))
            asked, begin = np.unique(shard[order], return_index=True)
            if not len(asked):
                continue
            begin, n = np.append(begin, len(order)), len(asked)
            asks = {
                "shard": pa.array(asked.astype(np.int32)), "model": pa.array(np.zeros(n, bool)), "batch": pa.array(np.full(n, number)),
                "keys": _lists(keys[order], begin), "docs": _lists(of[order], begin),
            }
            yield _table(ASKED, n, asks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The model's weights but the most frequent, in a row for each shard of about PACK of them."""
        held, size = [], 0

        def dealt() -> pa.RecordBatch:
            keys, weights = (np.concatenate(x) for x in zip(*held))
            shard = _spread(keys) % shards
            order = np.lexsort((keys, shard))
            found, begin = np.unique(shard[order], return_index=True)
            begin, n = np.append(begin, len(order)), len(found)
            return _table(ASKED, n, {"shard": pa.array(found.astype(np.int32)), "model": pa.array(np.ones(n, bool)), "keys": _lists(keys[order], begin), "weights": _lists(weights[order], begin)})

        for batch in batches:
            key, c, weight = weigh(batch)
            held.append((key[c < least], weight[c < least]))
            size += len(held[-1][0])
            if size >= PACK:
                yield dealt()
                held, size = [], 0
        if size:
            yield dealt()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition's shards one after the other: first the model's rows, then the documents'."""
        now, parts, keys, weights = None, [], np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            is_model = batch.column("model").to_numpy(zero_copy_only=False)
            shard = batch.column("shard").to_numpy()
            for k in range(len(batch)):
                if now != shard[k]:
                    now, parts, keys, weights = shard[k], [], np.zeros(0, np.int64), np.zeros(0)
                values = lambda name: batch.column(name).slice(k, 1).flatten().to_numpy()  # noqa: B023, E731
                if is_model[k]:
                    parts.append((values("keys").copy(), values("weights").copy()))
                    continue
                if batch.column("ids")[k].is_valid:
                    own = {n: batch.column(n).slice(k, 1) for n in ("batch", "docs", "ids", "hs", "langs", "ns")}
                    yield _table(ANSWERED, 1, own | {"sums": batch.column("weights").slice(k, 1)})
                    continue
                if parts:
                    keys, weights = (np.concatenate(x) for x in zip(*parts))
                    order = np.argsort(keys)
                    keys, weights, parts = keys[order], weights[order], []
                asked, of = values("keys"), values("docs")
                if not len(keys):
                    continue
                place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                known = keys[place] == asked
                which, at = np.unique(of[known], return_inverse=True)
                if len(which):
                    bounds = np.array([0, len(which)])
                    sums = np.bincount(at, weights[place[known]])
                    yield _table(ANSWERED, 1, {"batch": batch.column("batch").slice(k, 1), "docs": _lists(which, bounds), "sums": _lists(sums, bounds)})

    def total(table: pa.Table) -> pa.Table:
        """One batch's documents with all their sums."""
        own = table.filter(pa.compute.is_valid(table["ids"]))
        columns = [own[n].combine_chunks().flatten() for n in ("ids", "hs", "langs", "ns")]
        docs, sums = (table[n].combine_chunks().flatten().to_numpy() for n in ("docs", "sums"))
        return pa.table([*columns, pa.array(np.bincount(docs, sums, minlength=len(columns[0])))], [f.split()[0] for f in SCORED.split(", ")])

    rows = texts_of(docs, id_col, text_col, F.col(lang_col).alias("lang")).withColumn("id", F.col("id").cast("long"))
    rows = rows.withColumn("h", F.coalesce(F.xxhash64("text"), F.lit(0)))
    asked = rows.select("id", "text", "lang", "h").mapInArrow(ask, ASKED)
    # Each shard has its part of the model once, and there are as many as the model needs for parts of bounded size.
    both = asked.unionByName(model.counts.mapInArrow(pack, ASKED)).repartition(shards, "shard")
    both = both.sortWithinPartitions("shard", F.desc("model"))
    sums = both.mapInArrow(answer, ANSWERED).groupBy("batch").applyInArrow(total, SCORED)
    # Equal rows have equal sums, but for the last digits.
    return sums.groupBy("id", "h", "lang").agg(F.max("n").alias("n"), F.max("log10_p").alias("log10_p"))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    train_docs: int | None = None,
    quantile: float = 0.999,
    prior: int = 10,
    fewest: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``(id, h, lang, n_tokens, log10_ppl, limit, kept)`` of every different (id, text, language).

    ``labels`` has the id and ``quality``, 1 for trusted rows. The model learns from half of them, by hash, or from at most
    ``train_docs`` of that half; the limits come from all others. Without trusted rows, and so without limits, every text with words is kept.
    """
    sample = materialise(trusted_sample(docs, labels, train_docs, id_col, text_col), "sample")
    model = train(sample)
    drop_written(sample)
    rows = materialise(scored(docs, model, id_col, text_col, lang_col), "scores")
    drop_written(model.counts)
    trusted = labels.where("quality = 1").select(F.col(id_col).cast("long").alias("id")).distinct()
    learnt = training_ids(labels, train_docs, id_col).select(F.col("id").cast("long").alias("id"))
    held = rows.where("n > 1").join(trusted, "id", "left_semi").join(learnt, "id", "left_anti")
    held = materialise(held, "held")
    # One row per language.
    means = held.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), (-F.sum("log10_p") / F.sum("n")).alias("mean"))
    overall = held.agg((-F.sum("log10_p") / F.sum("n")).alias("all_mean"))

    def drawn(frame: DataFrame) -> DataFrame:
        frame = frame.withColumn("_l", F.coalesce("lang", F.lit("\0")))
        with_mean = frame.join(F.broadcast(means.select(F.coalesce("lang", F.lit("\0")).alias("_l"), "texts", "mean")), "_l", "left")
        with_mean = with_mean.join(F.broadcast(overall))
        mean = F.when(F.col("texts") >= fewest, F.col("mean")).otherwise(F.coalesce("all_mean", F.lit(0.0)))
        value = (-F.col("log10_p") + F.lit(prior) * mean) / (F.col("n") + F.lit(prior))
        return with_mean.withColumn("log10_ppl", F.when(F.col("n") > 1, value)).drop("mean", "all_mean")

    shown = drawn(held)
    by_lang = shown.groupBy("_l").agg(F.percentile_approx("log10_ppl", quantile, 100000).alias("own"))
    of_all = shown.agg(F.percentile_approx("log10_ppl", quantile, 100000).alias("any"))
    out = drawn(rows).join(F.broadcast(by_lang), "_l", "left").join(F.broadcast(of_all))
    limit = F.when(F.col("texts") >= fewest, F.col("own")).otherwise(F.col("any"))
    kept = F.col("log10_ppl").isNotNull() & F.coalesce(F.col("log10_ppl") <= F.col("limit"), F.lit(True))
    return out.withColumn("limit", limit).select("id", "h", "lang", F.col("n").alias("n_tokens"), "log10_ppl", "limit", kept.alias("kept"))


def by_row(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, lang, n_tokens, log10_ppl, limit, kept)`` of every row of ``docs``, repeated rows included."""
    found = decisions.select(F.col("id").alias("_i"), F.col("h").alias("_h"), F.col("lang").alias("_g"), "n_tokens", "log10_ppl", "limit", "kept")
    key = F.coalesce(F.xxhash64(F.col(text_col).cast("string").cast("binary")), F.lit(0))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), key.alias("_key"))
    on = rows["id"].eqNullSafe(found["_i"]) & (rows["_key"] == found["_h"]) & rows["lang"].eqNullSafe(found["_g"])
    return rows.join(found, on, "left").drop("_key", "_i", "_h", "_g")


def kept(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that were kept, with all their columns, repeated rows included."""
    good = decisions.where("kept").select(F.col("id").alias("_i"), F.col("h").alias("_h"), F.col("lang").alias("_g"))
    rows = docs.withColumn("_key", F.coalesce(F.xxhash64(F.col(text_col).cast("string").cast("binary")), F.lit(0)))
    on = rows[id_col].cast("long").eqNullSafe(good["_i"]) & (rows["_key"] == good["_h"]) & rows[lang_col].eqNullSafe(good["_g"])
    return rows.join(good, on, "left_semi").drop("_key")
