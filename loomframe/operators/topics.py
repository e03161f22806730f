"""Topics of documents by variational inference on a table of term counts.

Topics are a table with a row per term. Documents are dealt over groups. In a pass each group fetches the rows of its own
terms once, settles its documents' mixes of topics together, and adds up what the terms give to the topics; the next
topics are a grouped sum. The bound on the log-likelihood never falls from pass to pass, and passes end when it hardly
rises. Only the topics' totals and the bound, a number per topic, reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from loomframe.operators.ordering import dictionary
from loomframe.operators.relational import lookup
from loomframe.session import drop_written, materialise

# Entries of the documents of a group, of those that are looked up at once, and of those that are settled together.
GROUP_ENTRIES = 4_000_000
PART_ENTRIES = 100_000
PIECE_ENTRIES = 20_000


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of :func:`log_gamma`."""
    x, out = np.array(x, np.float64), np.zeros(np.shape(x))
    for _ in range(8):
        out -= 1 / x
        x += 1
    f = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))


def log_gamma(x: np.ndarray) -> np.ndarray:
    x, out = np.array(x, np.float64), np.zeros(np.shape(x))
    for _ in range(8):
        out -= np.log(x)
        x += 1
    f = 1 / (x * x)
    series = (1 / 12 - f * (1 / 360 - f * (1 / 1260 - f / 1680))) / x
    return out + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series


@dataclass
class Topics:
    """``terms (term, weights)``: a topic's share of terms sums to one over the table. ``documents (key, mix)`` of those
    that have a term. ``history``: ``(pass, log_likelihood, log_perplexity)``; the first is a bound from below."""

    terms: DataFrame
    documents: DataFrame
    history: list[tuple[int, float, float]]

    @property
    def log_likelihood(self) -> float:
        return self.history[-1][1]

    @property
    def log_perplexity(self) -> float:
        """Minus the log-likelihood per token."""
        return self.history[-1][2]


def _matrix(column: pa.ListArray, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _lists(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(rows.reshape(-1)))


def _expected(weights: DataFrame, totals: np.ndarray, eta: float) -> DataFrame:
    """``(no, expected, part)``: a term's row of exponentiated expected logs, and its part of the topics' bound."""
    base, k = digamma(totals), len(totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("weights"), k)
            logs = digamma(rows) - base
            part = ((eta - rows) * logs + log_gamma(rows) - log_gamma(np.array(eta))).sum(axis=1)
            yield pa.record_batch([batch.column("no"), _lists(np.exp(logs)), pa.array(part)], ["no", "expected", "part"])

    return weights.mapInArrow(run, "no bigint, expected array<double>, part double")


def _batches(lengths: np.ndarray, entries: int) -> Iterator[np.ndarray]:
    """Documents in batches of like lengths, the longest first, of at most about that many entries."""
    order = np.argsort(-lengths, kind="stable")
    ranked, low = lengths[order], 0
    while low < len(order):
        alike = int(np.searchsorted(-ranked[low:], -0.8 * ranked[low], side="right"))
        high = low + max(1, min(alike, entries // int(ranked[low])))
        yield order[low:high]
        low = high


def _settle(counts: np.ndarray, doc: np.ndarray, expected: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(gamma, what each entry gives to the topics, bound)`` of documents, each iterated until its own mix is settled.

    ``doc`` numbers the document of each entry from 0, ascending; every document has an entry. Documents of like lengths
    are iterated together, as products of matrices that are filled up with entries of no count.
    """
    k, first = expected.shape[1], np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    lengths = np.diff(np.r_[first, len(doc)])
    gamma = alpha + np.repeat(np.add.reduceat(counts, first)[:, None] / k, k, axis=1)

    def mix(g: np.ndarray) -> np.ndarray:
        found = digamma(np.concatenate([g, g.sum(axis=1, keepdims=True)], axis=1))
        return found[:, :-1] - found[:, -1:]

    for live in _batches(lengths, PIECE_ENTRIES):
        places = np.arange(lengths[live[0]])
        inside = places < lengths[live][:, None]
        at = np.where(inside, first[live][:, None] + places, 0)
        n = np.where(inside, counts[at], 0.0)[:, None, :]
        # A row per topic, so that all steps run along the entries.
        e = np.ascontiguousarray(np.where(inside[:, :, None], expected[at], 0.0).transpose(0, 2, 1))
        g, going = gamma[live], np.ones(len(live), bool)
        for _ in range(100):
            theta = np.exp(mix(g))
            norm = theta[:, None, :] @ e + 1e-100
            moved = alpha + theta * (e @ (n / norm).transpose(0, 2, 1))[:, :, 0]
            settled = np.abs(moved - g).mean(axis=1) < 1e-4
            g[going] = moved[going]
            going &= ~settled
            if not going.any():
                break
            if going.mean() < 0.7:
                gamma[live] = g
                n, e, g, live = n[going], e[going], g[going], live[going]
                going = going[going]
        gamma[live] = g
    logs = mix(gamma)
    wide = np.exp(logs)[doc]
    norm = (expected * wide).sum(axis=1) + 1e-100
    given = expected * wide * (counts / norm)[:, None]
    bound = np.add.reduceat(counts * np.log(norm), first)
    bound += ((alpha - gamma) * logs + log_gamma(gamma)).sum(axis=1) - log_gamma(gamma.sum(axis=1))
    return gamma, given, bound + float(log_gamma(np.array(alpha * k)) - k * log_gamma(np.array(alpha)))


def fit_topics(counts: DataFrame, k: int, passes: int = 20, tolerance: float = 1e-4, seed: int = 0) -> Topics:
    """Topics of ``(key, term, n)``, one row per document and term with a positive count.

    ``alpha`` and ``eta``, the weights of the priors, are ``1 / k``. Terms are not cut by number; leave out rare ones
    before if they are not wanted (``term_counts`` has a least document frequency). An empty table raises ValueError.
    """
    alpha = eta = 1.0 / k
    names = materialise(dictionary(counts, "term").withColumnRenamed("index", "no"), "terms")
    rows = materialise(lookup(counts.select("key", "term", F.col("n").cast("double").alias("n")), names, "term", missing="drop").drop("term"), "counts")
    start = rows.groupBy("no").agg(F.sum("n").alias("n"))
    v, tokens = start.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not v:
        raise ValueError("no terms")
    drawn = [F.lit(0.5) + F.pmod(F.xxhash64("no", F.lit(seed), F.lit(t)), F.lit(1 << 20)) / float(1 << 20) for t in range(k)]
    weights = materialise(start.select("no", F.array(*[eta + F.col("n") / k * d for d in drawn]).alias("weights")), "topics")
    totals_of = lambda df: np.array(df.agg(*[F.sum(F.get("weights", F.lit(t))) for t in range(k)]).first(), np.float64)
    kind = dict(counts.dtypes)["key"]
    # Documents are dealt over groups; a group fetches the rows of its own terms, once each, and gives back as many.
    entries, width = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    groups = max(math.ceil(entries / GROUP_ENTRIES), min(width, math.ceil(entries / PIECE_ENTRIES)))
    group = F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("group")
    packed = rows.groupBy("key").agg(F.collect_list(F.struct("no", "n")).alias("entries"))
    packed = materialise(packed.select(group, "key", "entries.no", "entries.n"), "packed")
    asked = materialise(packed.select(F.col("group").alias("asker"), F.explode("no").alias("no")).distinct(), "asked")
    drop_written(rows)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        numbers = right.column("no").to_numpy()
        order = np.argsort(numbers)
        numbers = numbers[order]
        expected = _matrix(right.column("expected").combine_chunks(), k)[order]
        total, none = np.zeros((len(numbers), k)), left.schema.field("key").type
        docs = left.select(["key", "no", "n"]).combine_chunks()
        lengths = np.asarray(pc.list_value_length(docs.column("no").combine_chunks()))
        pieces = (np.cumsum(lengths) - 1) // PART_ENTRIES
        edges = np.r_[np.flatnonzero(np.r_[True, pieces[1:] != pieces[:-1]]), len(lengths)]
        found = []
        for low, high in zip(edges[:-1], edges[1:]):
            part = docs.slice(low, high - low)
            at = np.searchsorted(numbers, part.column("no").combine_chunks().flatten().to_numpy())
            n = part.column("n").combine_chunks().flatten().to_numpy()
            gamma, given, bound = _settle(n, np.repeat(np.arange(high - low), lengths[low:high]), expected[at], alpha)
            for t in range(k):
                total[:, t] += np.bincount(at, given[:, t], len(numbers))
            columns = [part.column("key").combine_chunks(), pa.nulls(high - low, pa.int64()), _lists(gamma), pa.array(bound)]
            found.append(pa.table(columns, ["key", "no", "values", "bound"]))
        columns = [pa.nulls(len(numbers), none), pa.array(numbers), _lists(total), pa.nulls(len(numbers), pa.float64())]
        return pa.concat_tables([*found, pa.table(columns, ["key", "no", "values", "bound"])])

    history: list[tuple[int, float, float]] = []
    done = None
    for number in range(passes):
        totals = totals_of(weights)
        expected = materialise(_expected(weights, totals, eta), "expected")
        topics = expected.agg(F.sum("part")).first()[0] + float(k * log_gamma(np.array(v * eta)) - log_gamma(totals).sum())
        known = asked.join(expected.select("no", "expected"), "no")
        settled = packed.groupBy("group").cogroup(known.groupBy("asker"))
        step = materialise(settled.applyInArrow(run, f"key {kind}, no bigint, values array<double>, bound double"), "pass")
        bound = step.agg(F.sum("bound")).first()[0] + topics
        history.append((number, bound, -bound / tokens))
        ended = number + 1 == passes or (number > 0 and bound - history[-2][1] < tolerance * abs(bound))
        drop_written(expected)
        if ended:
            done = step.where("no IS NULL")
            break
        sums = [(F.lit(eta) + F.sum(F.get("values", F.lit(t)))).alias(f"w{t}") for t in range(k)]
        moved = step.where("no IS NOT NULL").groupBy("no").agg(*sums).select("no", F.array(*[f"w{t}" for t in range(k)]).alias("weights"))
        moved = materialise(moved, "topics")
        drop_written(step)
        drop_written(weights)
        weights = moved
    for table in (packed, asked):
        drop_written(table)
    whole = totals_of(weights)
    shares = F.array(*[F.get("weights", F.lit(t)) / float(whole[t]) for t in range(k)])
    terms = weights.join(names, "no").select("term", shares.alias("weights"))
    total = F.aggregate("values", F.lit(0.0), lambda acc, x: acc + x)
    mixes = done.withColumn("total", total).select("key", F.transform("values", lambda x: x / F.col("total")).alias("mix"))
    return Topics(terms, mixes, history)


def top_terms(topics: Topics, n: int = 3) -> DataFrame:
    """``(topic, rank, term, weight)`` of the heaviest terms of each topic."""
    rows = topics.terms.select("term", F.posexplode("weights").alias("topic", "weight"))
    order = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.select("topic", "rank", "term", "weight")
