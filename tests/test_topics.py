import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.operators import topics


def test_gamma_functions():
    x = np.array([1e-3, 0.1, 0.5, 1.0, 2.5, 7.0, 100.0, 1e6])
    assert np.allclose(topics.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)
    step = 1e-6 * np.maximum(x, 1e-2)
    slope = (topics.log_gamma(x + step) - topics.log_gamma(x - step)) / (2 * step)
    assert np.allclose(topics.digamma(x), slope, rtol=1e-3)
    assert np.allclose(topics.digamma(np.array([1.0])), -0.5772156649015329)


def planted(spark):
    """Documents of three subjects with words of their own, and words that all share."""
    draw = np.random.default_rng(4)
    rows = []
    for d in range(120):
        words = [f"s{d % 3}w{k}" for k in draw.integers(0, 20, 40)] + [f"all{k}" for k in draw.integers(0, 10, 20)]
        rows += [(d, w, float(words.count(w))) for w in sorted(set(words))]
    return spark.createDataFrame(rows, "key long, term string, n double")


def test_planted_topics(spark):
    counts = planted(spark)
    found = topics.fit_topics(counts, 3, passes=30, tolerance=1e-6, seed=1)
    bounds = [h[1] for h in found.history]
    assert all(b >= a - 1e-6 for a, b in zip(bounds, bounds[1:]))
    single = topics.fit_topics(counts, 1, passes=3)
    assert found.log_likelihood > single.log_likelihood and found.log_perplexity < single.log_perplexity
    mixes = {r["key"]: r["mix"] for r in found.documents.collect()}
    assert len(mixes) == 120 and all(abs(sum(m) - 1) < 1e-9 for m in mixes.values())
    best = [max(range(3), key=lambda t: mixes[d][t]) for d in range(120)]
    named = {(d % 3, b) for d, b in enumerate(best)}
    assert len(named) == 3 and len({b for _, b in named}) == 3
    heavy = topics.top_terms(found, 5).collect()
    assert len(heavy) == 15 and all(r["term"].startswith(("s", "all")) for r in heavy)
    shares = found.terms.agg(*[F.sum(F.get("weights", F.lit(t))) for t in range(3)]).first()
    assert all(abs(x - 1) < 1e-9 for x in shares)


def test_a_single_topic_is_the_term_shares(spark):
    """With one topic the weights are the counts and the prior, and the perplexity is close to the entropy."""
    counts = planted(spark)
    found = topics.fit_topics(counts, 1, passes=3)
    sums = {r["term"]: r["n"] for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    whole = sum(sums.values()) + len(sums)
    assert all(abs(r["weights"][0] - (sums[r["term"]] + 1) / whole) < 1e-9 for r in found.terms.collect())


def test_documents_settled_together_are_those_settled_alone():
    draw = np.random.default_rng(2)
    sizes = [1, 7, 300, 2, 40]
    doc = np.repeat(np.arange(5), sizes)
    counts, expected = draw.integers(1, 5, len(doc)).astype(float), draw.random((len(doc), 3))
    gamma, given, bound = topics._settle(counts, doc, expected, 1 / 3)
    for d in range(5):
        own = doc == d
        # The plain iteration of one document.
        alone = np.full(3, 1 / 3 + counts[own].sum() / 3)
        for _ in range(100):
            theta = np.exp(topics.digamma(alone) - topics.digamma(alone.sum()))
            norm = expected[own] @ theta + 1e-100
            moved = 1 / 3 + theta * (expected[own].T @ (counts[own] / norm))
            change, alone = np.abs(moved - alone).mean(), moved
            if change < 1e-4:
                break
        assert np.allclose(gamma[d], alone, rtol=1e-9)
        one = topics._settle(counts[own], np.zeros(sizes[d], int), expected[own], 1 / 3)
        assert np.allclose(one[1], given[own]) and np.allclose(one[2], bound[d])
        assert np.allclose(given[own].sum(axis=1), counts[own])


def test_groups_and_pieces_change_nothing(spark, monkeypatch):
    whole = topics.fit_topics(planted(spark), 3, passes=4, seed=1)
    monkeypatch.setattr(topics, "GROUP_ENTRIES", 700)
    monkeypatch.setattr(topics, "PIECE_ENTRIES", 90)
    parts = topics.fit_topics(planted(spark), 3, passes=4, seed=1)
    assert np.allclose([h[1] for h in whole.history], [h[1] for h in parts.history], rtol=1e-9)
    assert parts.documents.count() == 120


def test_nothing_to_fit(spark):
    with pytest.raises(ValueError):
        topics.fit_topics(spark.createDataFrame([], "key long, term string, n double"), 2)
