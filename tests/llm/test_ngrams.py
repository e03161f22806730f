"""The trie's sequences, and scores against a plain model."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomframe.llm import ngrams
from loomframe.llm.elias_fano import EliasFano, Trie


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (1, 1 << 64), (5, 6), (1000, 1001), (900, 1 << 48), (5000, 1 << 64)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
    sequence = EliasFano.of(values, universe)
    assert (sequence.values(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe - 1, 300, dtype=np.uint64, endpoint=True), np.array([0, universe - 1], np.uint64)])
    assert (sequence.successor(asked) == np.searchsorted(values, asked)).all()


def test_trie_round_trip(tmp_path):
    context, word = np.array([3, 3, 9, 9, 9], np.uint64), np.array([5, 8, 1, 5, 7], np.uint64)
    trie = Trie.build(context, word, np.array([0.5, 0.25, 0.1, 0.2, 0.3]), np.array([0.25, 0.4]))
    trie.save(str(tmp_path / "trie"))
    for t in (trie, Trie.load(str(tmp_path / "trie"))):
        assert (t.look_up(context, word) > 0).all()
        assert t.look_up(np.array([3, 9, 4, 3], np.uint64), np.array([1, 8, 5, 6], np.uint64)).tolist() == [0] * 4
        assert t.followers_of(9)[0].tolist() == [1, 5, 7] and len(t.followers_of(4)[0]) == 0


def plain(rows, k):
    out, single, pair, context = {}, Counter(), Counter(), Counter()
    tokens = {i: ["<s>", *[w.lower() for w in (t or "").encode().split()], "</s>"] for i, t in rows}
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in tokens}
    for i, x in tokens.items():
        if not held[i]:
            single.update(x[1:])
            pair.update(zip(x, x[1:]))
            context.update(x[:-1])
    n, v = sum(single.values()), len(single)
    for i, x in tokens.items():
        p1 = lambda w: (single[w] + 0.1) / (n + 0.1 * (v + 1))
        base = sum(math.log10(p1(w)) for w in x[1:])
        score = sum(math.log10((pair[a, b] + k * p1(b)) / (context[a] + k)) for a, b in zip(x, x[1:]))
        out[i] = (held[i], len(x) - 1, sum(single[w] > 0 for w in x[1:]), n, base, score)
    return out


def test_scores(spark, docs):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(30)] + [f"R{k}" for k in range(500)]
    weights = [30 / (k + 1) for k in range(30)] + [0.05] * 500
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 80))) for _ in range(200)]
    rows = list(enumerate(texts + texts[:30])) + [(900, None), (901, ""), (902, " \n"), (None, "w1 W1 unseen"), (903, "w1 w2 " * 30000)]
    frame = docs(rows).withColumn("batch", F.lit("clash")).withColumn("held", F.lit(1))
    want = plain(rows, ngrams.K)
    for options in ({}, {"batch_bytes": 2000, "shard_bytes": 3000}, {"batch_bytes": 40000, "shard_bytes": 200}):
        found = ngrams.scores(frame, **options).collect()
        assert len(found) == len(rows)
        for r in found:
            held, n, known, total, base, score = want[r["id"]]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
            assert r["base_score"] == pytest.approx(base, rel=1e-9)
            # Codes are rounded down by 1 part in 2,000 of a probability at most.
            assert r["score"] == pytest.approx(score, rel=1e-3, abs=n * 3e-4) and r["score"] <= score + 1e-6
    assert ngrams.scores(docs([])).count() == 0
    alone = ngrams.scores(docs([(k, "a b") for k in range(2000) if zlib.crc32(str(k).encode()) % 10 == 0][:3])).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in alone)


def test_requests_follow_what_is_asked():
    """However many shards there are, a batch has a row for those that it needs."""
    text = " ".join(f"w{k % 50}" for k in range(200)).encode()
    table = pa.table({"batch": pa.array([3], pa.int32()), "held": [False], "text": pa.array([text], pa.binary())})
    sizes = [ngrams._ask(shards, np.zeros(0, np.uint64))(table).num_rows for shards in (4, 100, 100_000)]
    assert sizes[0] == 4 and sizes[1] <= 100 and sizes[2] <= 51 + 52
