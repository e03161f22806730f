"""The quality model against a plain modified Kneser-Ney model, its properties and its decisions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.llm import quality, words


def plain_tokens(text, known):
    out, run = [], 0
    raw = (text or "").encode().split()
    for k, w in enumerate(raw):
        run = run + 1 if k and raw[k - 1] == w else 0
        if run:
            out.append(("repeat", min(run, quality.RUN)))
        elif w in known:
            out.append(w)
        else:
            kinds = set()
            for b in w:
                c = chr(b)
                kinds.add("low" if b > 127 or c.islower() else "up" if c.isupper() else "digit" if c.isdigit() else "stop" if c in "!',.:;?" else "other")
            out.append(frozenset(kinds))
    return out


class Plain:
    def __init__(self, texts):
        seen = Counter(w for t in texts for w in t.encode().split())
        self.known = {w for w, n in seen.items() if n >= 2}
        tri = Counter()
        for t in texts:
            x = ["^", "^", *plain_tokens(t, self.known), "$"]
            tri.update(zip(x, x[1:], x[2:]))
        bi = defaultdict(int)
        for (u, v, w), n in tri.items():
            bi[v, w] += n if v == "^" else 1
        uni = Counter(w for _, w in bi)
        self.size = len(self.known) + 32 + quality.RUN + 1
        self.levels = [self.level({(w,): n for w, n in uni.items()}), self.level(dict(bi)), self.level(dict(tri))]

    def level(self, counts):
        n = [0, *(sum(c == k for c in counts.values()) for k in (1, 2, 3, 4))]
        if n[1] and n[2]:
            y = n[1] / (n[1] + 2 * n[2])
            d = [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2, 0.1), k - 0.05) for k in (1, 2, 3)]
        else:
            d = [0.5, 1.0, 1.5]
        total, left = Counter(), Counter()
        for g, c in counts.items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3) - 1]
        return counts, d, total, left

    def p(self, gram):
        lower = self.p(gram[1:]) if len(gram) > 1 else 1 / self.size
        counts, d, total, left = self.levels[len(gram) - 1]
        h = gram[:-1]
        if not total[h]:
            return lower
        c = counts.get(gram, 0)
        return (c - d[min(c, 3) - 1] if c else 0) / total[h] + left[h] / total[h] * lower

    def score(self, text):
        x = ["^", "^", *plain_tokens(text, self.known), "$"]
        return sum(math.log10(self.p(tuple(x[i : i + 3]))) for i in range(len(x) - 2))


def made(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + [f"Rare{k}x" for k in range(400)]
    weights = [40 / (k + 1) for k in range(40)] + [0.02] * 400
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("frequent", [quality.FREQUENT, 300, 1])
def test_scores_are_those_of_a_plain_model(spark, docs, monkeypatch, frequent):
    monkeypatch.setattr(quality, "FREQUENT", frequent)
    texts = made(60)
    sample = docs(list(enumerate(texts[:40]))).select(F.col("doc_id").alias("id"), words.as_bytes("text").alias("text"))
    plain, model = Plain(texts[:40]), quality.train(sample)
    rows = [*texts, None, "", " \n", "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1", "NEVER!! seen 12 | é", texts[0], "w2 w3 " * 20000]
    frame = docs(list(enumerate(rows))).withColumn("h", F.lit("clash")).withColumn("keys", F.lit(1))
    found = {r["id"]: r for r in quality.scored(frame, model).collect()}
    for k, text in enumerate(rows):
        assert found[k]["n"] == len((text or "").split()) + 1
        assert found[k]["log10_p"] == pytest.approx(plain.score(text), rel=1e-9)
    # A proper distribution: after any context the tokens' probabilities sum to 1.
    every = [*plain.known, "$", *[("repeat", k) for k in range(1, quality.RUN + 1)]]
    kinds = [frozenset(k for i, k in enumerate(("low", "up", "digit", "stop", "other")) if n >> i & 1) for n in range(32)]
    for context in (("^", "^"), (b"w0", b"w1"), (b"w0", "$")):
        assert sum(plain.p((*context, w)) for w in [*every, *kinds]) == pytest.approx(1)


def test_tokens_do_not_depend_on_the_stretches():
    texts = [t.encode() for t in made(20)] + [b"", b"a a a b b", b"b"]
    vocabulary = quality.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    whole = vocabulary.tokens(*words.joined_parts(texts))
    kept, words.CHUNK = words.CHUNK, 5
    try:
        parts = vocabulary.tokens(*words.joined_parts(texts))
    finally:
        words.CHUNK = kept
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert whole[0][-6:].tolist() == [1, quality.REPEAT, quality.REPEAT + 1, 1, quality.REPEAT, 1]


def test_decisions(spark, docs):
    good = made(400, 3)
    junk = ["W1!! NO% " * 30, "w3 " * 40, "| " * 50, "Rare7x " * 30]
    rows = [(k, t, "en" if k % 2 else "de") for k, t in enumerate(good)] + [(1000 + k, t, ["en", None][k % 2]) for k, t in enumerate(junk)]
    rows += [(2000, None, "en"), (2001, "", "xx"), (2002, good[0], None), (2002, good[0], None), (None, good[1], "en")]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 400, 2)] + [(k, 1, 0) for k in range(1, 200, 2)] + [(1000, 0, 0)], "doc_id long, quality int, toxic int")
    frame = docs(rows)
    found = {r["id"]: r for r in quality.judged(frame, labels, train_docs=100, fewest=20).collect()}
    assert not any(found[1000 + k]["kept"] for k in range(4))
    assert not found[2000]["kept"] and found[2000]["log10_ppl"] is None and not found[2001]["kept"]
    assert sum(found[k]["kept"] for k in range(400)) >= 396
    assert found[2002]["kept"] and found[None]["kept"]
    decisions = quality.judged(frame, labels, train_docs=100, fewest=20)
    left = quality.kept(frame, decisions)
    assert left.columns == frame.columns and left.where("doc_id = 2002").count() == 2 and left.where("doc_id is null").count() == 1
    assert quality.judged(docs([]), labels).count() == 0
    none = quality.judged(frame.limit(5), labels.where("false")).collect()
    assert len(none) == 5


def test_repeated_rows_are_judged_as_single_ones(spark, docs):
    good = made(200, 5)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    once = [(k, t, "en") for k, t in enumerate(good)] + [(None, None, "en"), (900, "", "en"), (901, " \n", None), (902, "W1!! NO% w2", "en"), (None, good[0], "en")]
    often = [*once, *[r for r in once[200:] for _ in range(6)]]
    want = quality.judged(docs(once), labels, train_docs=50, fewest=20).collect()
    frame = docs(often)
    decisions = quality.judged(frame, labels, train_docs=50, fewest=20)
    key = lambda r: (str(r["id"]), r["h"])
    for a, b in zip(sorted(want, key=key), sorted(decisions.collect(), key=key), strict=True):
        assert (a["id"], a["lang"], a["n_tokens"], a["limit"], a["kept"]) == (b["id"], b["lang"], b["n_tokens"], b["limit"], b["kept"])
        assert a["log10_ppl"] == (b["log10_ppl"] and pytest.approx(b["log10_ppl"]))
    assert quality.kept(frame, decisions).where("trim(text, ' \n') = '' or text is null").count() == 0
    rows = quality.by_row(frame, decisions).collect()
    assert len(rows) == len(often) and all(r["n_tokens"] is not None for r in rows)
    blank = [r for r in rows if r["log10_ppl"] is None]
    assert len(blank) == 21 and not any(r["kept"] for r in blank)


def test_the_model_learns_from_all_trusted_texts_of_the_half(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "FREQUENT", 200)
    for name, value in (("SHARD", 300), ("PACK", 500)):
        monkeypatch.setattr(quality, name, value, raising=False)
    rng = random.Random(9)
    texts = [" ".join(rng.choices([f"w{k}" for k in range(60)], k=rng.randint(1, 6))) for _ in range(5000)]
    frame = docs(list(enumerate(texts)))
    labels = spark.createDataFrame([(k, 1, 0) for k in range(5000)], "doc_id long, quality int, toxic int")
    half = [r["doc_id"] for r in labels.where("pmod(xxhash64(doc_id), 2) = 0").collect()]
    assert len(half) > 2300
    plain = Plain([texts[k] for k in half])
    found = {r["id"]: r for r in quality.judged(frame, labels, prior=0).collect()}
    assert len(found) == len(texts)
    for k in range(0, 5000, 50):
        assert found[k]["log10_ppl"] == pytest.approx(-plain.score(texts[k]) / found[k]["n_tokens"], rel=1e-9)
