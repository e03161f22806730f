"""Language-model scores from an n-gram trie in Elias-Fano form, learnt from the whole corpus and as large as it.

Documents are dealt into batches by a hash of their id. A batch asks for what it needs: its different words and its
different pairs of a word and the one before, with their numbers in training texts. Requests go to shards of the
model by the first word of the pair (pairs of very frequent first words by both), so a pair comes at most once
from a batch, however often it stands there, and no shard depends on one word's frequency. A shard adds the counts up,
builds its part of the trie, looks all asked pairs up in it, and answers each batch with the counts of its words and
a 16-bit code per pair. The batch, read from the same exchange of texts, then scores its documents.

The model is p(w | v) = (n(v w) + K p(w)) / (n(v) + K), with p(w) = (n(w) + 0.1) / (N + 0.1 (V + 1)): probabilities
of all words, one more for any unknown, sum to 1. The trie keeps n(v w) / (n(v) + K) and K / (n(v) + K) as codes.

Words are told apart by 64-bit hashes, a pair's second word by 48 bits of its hash among the first word's followers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.llm.elias_fano import Trie, dequantised
from loomframe.llm.words import binary_parts, mix, sliced, texts_of, word_hashes
from loomframe.session import materialise

#: Pseudo-counts of the single-word probabilities in a context.
K = 4.0
#: Bytes of text in a batch, and pairs asked of a shard, about.
BATCH_BYTES = 8 << 20
SHARD_BYTES = 16 << 20
#: First words whose pairs are dealt by both words: the most frequent ones, at most this many.
FREQUENT = 1024
START, END = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)


def held_out(key: str | Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text divides by 10 (a null id counts as empty)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 10 == 0


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(words of all texts, an end behind each text's, and their numbers)``."""
    hashes, counts = word_hashes(*binary_parts(column))
    out = np.full(len(hashes) + len(counts), END, np.uint64)
    out[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes
    return out, counts + 1


def totals(rows: DataFrame) -> tuple[int, int, int, np.ndarray, np.ndarray]:
    """``(N, V, training texts, frequent first words, their counts)`` of ``(text, held)``; the start is one of them.

    The driver sees a row of sums and at most FREQUENT words.
    """

    def run(batches):
        for batch in sliced(batches, 4096):
            words, _ = _sequences(batch.column("text"))
            word, n = np.unique(words, return_counts=True)
            yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    counted = rows.where(~F.col("held")).select("text").mapInArrow(run, "word bigint, n bigint")
    counts = materialise(counted.groupBy("word").agg(F.sum("n").alias("n")), "counts")
    texts = F.sum(F.when(F.col("word") == int(END.view(np.int64)), F.col("n")))
    row = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), texts.alias("texts")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    words = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    words, counts = np.append(words, START), np.append(np.array([r["n"] for r in top], np.int64), row["texts"] or 0)
    order = np.argsort(words)
    return row["n"] or 0, row["v"], row["texts"] or 0, words[order], counts[order]


def _in(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return sorted_[place] == values


class Needs:
    """The different words and pairs of a batch, dealt to shards; the same whoever computes it."""

    def __init__(self, text: pa.Array, shards: int, frequent: np.ndarray):
        self.words, self.sizes = _sequences(text)
        ends = np.cumsum(self.sizes)
        before = np.empty_like(self.words)
        before[1:] = self.words[:-1]
        before[ends - self.sizes] = START
        self.kinds, self.word_of = np.unique(self.words, return_inverse=True)
        kinds, self.context_of = np.unique(before, return_inverse=True)
        self.contexts = kinds
        pair = self.context_of.astype(np.int64) * len(self.kinds) + self.word_of
        pairs, self.pair_of = np.unique(pair, return_inverse=True)
        self.pair_context = kinds[pairs // max(1, len(self.kinds))]
        self.pair_word = self.kinds[pairs % max(1, len(self.kinds))]
        self.word_shard = (mix(self.kinds) % np.uint64(shards)).astype(np.int64)
        self.spread = _in(frequent, self.pair_context)
        by = np.where(self.spread, self.pair_context ^ self.pair_word, self.pair_context)
        self.pair_shard = (mix(by) % np.uint64(shards)).astype(np.int64)

    def orders(self) -> tuple[np.ndarray, np.ndarray]:
        """Words and pairs in the order of their shards, a shard's pairs of frequent first words last."""
        return np.argsort(self.word_shard, kind="stable"), np.argsort(2 * self.pair_shard + self.spread, kind="stable")


def _six(values: np.ndarray) -> bytes:
    return np.ascontiguousarray((values >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


# A first word that is not frequent is in its pairs' shard as a word, so the number of its followers names it. A batch
# has a row for each shard that it asks something of, so there are no more rows than words and pairs of batches.
ASKED = (
    "shard int, batch int, words binary, counts binary, followers binary, contexts binary, context_followers binary, "
    "next binary, pairs binary"
)
ANSWERED = "batch int, shard int, counts binary, codes binary"


def _ask(shards: int, frequent: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        batch = table["batch"][0].as_py()
        need = Needs(table["text"].combine_chunks(), shards, frequent)
        trained = np.repeat(~table["held"].to_numpy(zero_copy_only=False), need.sizes)
        words = np.bincount(need.word_of[trained], minlength=len(need.kinds))
        pairs = np.bincount(need.pair_of[trained], minlength=len(need.pair_word))
        by_word, by_pair = need.orders()
        w_ends = np.searchsorted(need.word_shard[by_word], np.arange(shards + 1))
        p_ends = np.searchsorted((2 * need.pair_shard + need.spread)[by_pair], np.arange(2 * shards + 1))
        rows = []
        for s in range(shards):
            w, p = by_word[w_ends[s] : w_ends[s + 1]], by_pair[p_ends[2 * s] : p_ends[2 * s + 2]]
            if not len(w) and not len(p):
                continue
            near, far = p[: p_ends[2 * s + 1] - p_ends[2 * s]], p[p_ends[2 * s + 1] - p_ends[2 * s] :]
            of = np.searchsorted(need.kinds[w], need.pair_context[near])
            contexts, followers = np.unique(need.pair_context[far], return_counts=True)
            columns = (need.kinds[w], words[w].astype("<u4"), np.bincount(of, minlength=len(w)).astype("<u4"), contexts, followers.astype("<u4"))
            rows.append((s, batch, *[c.tobytes() for c in columns], _six(need.pair_word[p]), pairs[p].astype("<u4").tobytes()))
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 7]
        names = [f.split()[0] for f in ASKED.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def _answer(frequent: np.ndarray, frequent_counts: np.ndarray, smoothing: float):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        # Words.
        each = [np.frombuffer(r["words"], "<u8") for r in rows]
        kinds, number = np.unique(np.concatenate(each), return_inverse=True)
        counts = np.concatenate([np.frombuffer(r["counts"], "<u4") for r in rows])
        total = np.bincount(number, counts, minlength=len(kinds)).astype(np.int64)[number]
        word_ends = np.cumsum([len(x) for x in each])
        # Pairs: distinct ones with their numbers in training texts.
        firsts, followers = [], []
        for r, own in zip(rows, each):
            counted = np.frombuffer(r["followers"], "<u4")
            firsts += [own[counted > 0], np.frombuffer(r["contexts"], "<u8")]
            followers += [counted[counted > 0], np.frombuffer(r["context_followers"], "<u4")]
        followers = np.concatenate(followers).astype(np.int64)
        contexts, rank = np.unique(np.concatenate(firsts), return_inverse=True)
        nexts = [_from_six(r["next"]) for r in rows]
        follower, place = np.unique(np.concatenate(nexts), return_inverse=True)
        pair = np.repeat(rank, followers) * np.int64(len(follower)) + place
        pairs, pair_of = np.unique(pair, return_inverse=True)
        n = np.bincount(pair_of, np.concatenate([np.frombuffer(r["pairs"], "<u4") for r in rows]), minlength=len(pairs))
        c, w = pairs // max(1, len(follower)), pairs % max(1, len(follower))
        # A context's whole number: that of its pairs here, or for frequent ones, whose pairs are spread, as given.
        whole = np.bincount(c, n, minlength=len(contexts))
        spread = _in(frequent, contexts)
        whole[spread] = frequent_counts[np.searchsorted(frequent, contexts[spread])]
        known = n > 0
        share = n[known] / (whole[c[known]] + smoothing)
        used = np.unique(c[known])
        trie = Trie.build(contexts[c[known]], follower[w[known]], share, smoothing / (whole[used] + smoothing))
        codes = trie.look_up(contexts[c], follower[w])[pair_of]
        pair_ends = np.cumsum([len(x) for x in nexts])
        words = [total[e - len(x) : e].astype("<u4" if total.max(initial=0) < 1 << 32 else "<u8") for e, x in zip(word_ends, each)]
        out = [codes[e - len(x) : e].astype("<u2") for e, x in zip(pair_ends, nexts)]
        return pa.table(
            [
                pa.array([r["batch"] for r in rows], pa.int32()),
                pa.array([r["shard"] for r in rows], pa.int32()),
                pa.array([x.tobytes() for x in words], pa.binary()),
                pa.array([x.tobytes() for x in out], pa.binary()),
            ],
            ["batch", "shard", "counts", "codes"],
        )

    return run


SCORED = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _score(shards: int, frequent: np.ndarray, n: int, v: int, texts: int, smoothing: float):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in SCORED.split(", ")]
        if not table.num_rows:
            return pa.table([pa.array([], k) for k in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names)
        need = Needs(table["text"].combine_chunks(), shards, frequent)
        by_word, by_pair = need.orders()
        counts, codes = np.zeros(len(need.kinds), np.int64), np.zeros(len(need.pair_word), np.uint16)
        found = sorted(answers.to_pylist(), key=lambda r: r["shard"])
        sizes = np.bincount(need.word_shard, minlength=shards)
        parts = [np.frombuffer(r["counts"], "<u8" if len(r["counts"]) == 8 * sizes[r["shard"]] else "<u4").astype(np.int64) for r in found]
        counts[by_word] = np.concatenate(parts)
        codes[by_pair] = np.concatenate([np.frombuffer(r["codes"], "<u2") for r in found])
        single = (counts + 0.1) / (n + 0.1 * (v + 1))
        # Contexts are words of the batch too, but for the start.
        of = np.minimum(np.searchsorted(need.kinds, need.contexts), len(need.kinds) - 1)
        whole = np.where(need.contexts == START, texts, counts[of])
        whole[(need.contexts != START) & (need.kinds[of] != need.contexts)] = 0
        backoff = smoothing / (whole + smoothing)
        p = dequantised(codes)[need.pair_of] + backoff[need.context_of] * single[need.word_of]
        starts = np.cumsum(need.sizes) - need.sizes
        return pa.table(
            [
                table["id"].cast(pa.int64()),
                table["held"],
                pa.array(need.sizes, pa.int64()),
                pa.array(np.add.reduceat((counts > 0)[need.word_of].astype(np.int64), starts)),
                pa.array(np.add.reduceat(np.log10(single)[need.word_of], starts)),
                pa.array(np.add.reduceat(np.log10(p), starts)),
            ],
            names,
        )

    return run


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", smoothing: float = K, batch_bytes: int = BATCH_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    A text's tokens are its words and one end; a null text has the end alone. ``base_score`` uses the single-word
    probabilities, ``score`` the model; both are log10. Without training texts every token is unknown.
    """
    spark = docs.sparkSession
    rows = texts_of(docs, id_col, text_col).withColumn("held", held_out("id"))
    n, v, texts, frequent, frequent_counts = totals(rows)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(width, math.ceil(size / batch_bytes))
    shards = max(4, math.ceil(size / shard_bytes))
    # Rows of equal ids, if there are any, are dealt by their texts as well.
    dealt = F.pmod(F.xxhash64("id", "text"), F.lit(count)).cast("int")
    batches = rows.withColumn("batch", dealt).repartition(count, "batch")
    asked = batches.groupBy("batch").applyInArrow(_ask(shards, frequent), ASKED)
    answered = asked.repartition(max(width, shards), "shard").groupBy("shard").applyInArrow(_answer(frequent, frequent_counts, smoothing), ANSWERED)
    answered = answered.repartition(count, "batch")
    scored = batches.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(_score(shards, frequent, n, v, texts, smoothing), SCORED)
    return scored.withColumn("train_tokens", F.lit(n).cast("bigint"))
