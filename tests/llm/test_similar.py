"""Fingerprints and the n-gram Jaccard join against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomframe.llm import fingerprints, jaccard


def shingles(text, k):
    words = [w.lower() for w in (text or "").encode().split()]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def brute(rows, k, numerator, denominator):
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and denominator * len(sets[a] & sets[b]) >= numerator * len(sets[a] | sets[b])]
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label, sets, links


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"W{k}" for k in range(300)]
    rows = []
    for length in (1, 2, 3, 4, 8, 12, 15, 21, 30, 60, 120, 300):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for copy in range(14):
            words = list(base)
            for _ in range(copy * length // 120 + (copy % 3 == 2)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 + 7, " ".join(words).lower() if copy % 2 else "\n".join(words)))
    rows += [(1, None), (2, ""), (3, " \t "), (4, "W1"), (5, "w1"), (None, "w1"), (6, " ".join(vocabulary) * 40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,numerator,denominator", [(3, 9, 10), (5, 4, 5), (1, 9, 10)])
def test_jaccard_join(spark, docs, k, numerator, denominator):
    rows = corpus()
    label, sets, links = brute(rows, k, numerator, denominator)
    assert len(links) > 100
    frame = docs(rows).withColumn("id", F.lit("clash")).withColumn("key", F.lit(1))
    found = jaccard.similar_sets(frame, k, numerator, denominator).collect()
    assert len(found) == len(rows)
    assert {r["id"]: r["component"] for r in found if r["id"] is not None} == label
    assert all(r["n"] == len(sets[r["id"]]) for r in found if r["id"] is not None)


def test_bands_cover_every_pair():
    bands = jaccard.Bands(9, 10)
    for n in range(1, 3000):
        for m in range(n, n * 10 // 9 + 1):
            if bands.allowed(n + m) < max(1, m - n):
                continue
            low, high = bands.of(n), bands.of(m)
            assert high[0] - low[0] in (0, 1)
            assert bands.allowed(n + m) <= bands.allowed(2 * high[2])
            assert low[0] == high[0] or n * 10 >= 9 * high[1]


def test_empty_tables(spark, docs):
    assert jaccard.similar_sets(docs([])).count() == 0
    assert fingerprints.near_duplicates(docs([])).count() == 0
    assert fingerprints.edited_fingerprints(docs([])).count() == 0


def test_near_duplicates(spark, docs):
    rows = corpus(9)
    label, _, _ = brute(rows, 5, 4, 5)
    found = {r["id"]: r["component"] for r in fingerprints.near_duplicates(docs(rows)).collect() if r["id"] is not None}
    assert found == label


def test_edited_fingerprints(spark, docs):
    rows = [r for r in corpus(3) if r[0] is not None] + [(1000, "ünï " * 50), (1001, "ünï " * 50)]
    found = {r["id"]: r for r in fingerprints.edited_fingerprints(docs(rows).withColumn("range", F.lit(9))).collect()}
    order = sorted(rows)
    assert len(found) == len(rows)
    prints = {r["id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs(rows)).collect()}
    for (i, text), (j, after) in zip(order, [*order[1:], order[0]]):
        text, after = text or "", after or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        got = found[i]
        assert got["n_chars"] == len(text) and got["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got["fingerprint"] == prints[i]
        places = lambda p: [p[k : k + 8] for k in range(0, len(p), 8)]
        for print_, near, other in ((got["edited_fingerprint"], got["near_edited"], edited), (prints[j], got["near_next"], after)):
            assert near == sum(a == b for a, b in zip(places(prints[i]), places(print_))) / 128
            a, b = shingles(text, 5), shingles(other, 5)
            assert abs(near - (len(a & b) / len(a | b) if a | b else 1)) < 0.2
    assert found[1000]["fingerprint"] == found[1001]["fingerprint"] and found[1000]["near_next"] == 1
    one = fingerprints.edited_fingerprints(docs([(7, "a b c d e f")])).collect()
    assert one[0]["near_next"] == 1 and one[0]["n_chars"] == 11
