"""The subspace join against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.llm import embeddings


def brute(rows, threshold):
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v, float) / np.abs(v).max()
            good[i] = x / np.linalg.norm(x)
    ids = sorted(good)
    links = {i: [j for j in ids if j != i and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold] for i in ids}
    label = {i: i for i, _ in rows}
    for _ in range(len(ids)):
        new = {i: min([label[i], *[label[j] for j in links.get(i, ())]]) if i is not None else None for i in label}
        if new == label:
            break
        label = new
    return {i: len(links.get(i, ())) for i in label}, label


def made(n, size, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(4, n // 40), size))
    rows = []
    for k in range(n):
        kind = k % 5
        base = centres[0] if kind == 0 else centres[k % len(centres)] if kind < 4 else rng.normal(size=size)
        rows.append((3 * k + 1, (base + rng.normal(size=size) * rng.choice([0.02, 0.2, 0.33, 0.45])).tolist()))
    return rows


@pytest.mark.parametrize("size,leaf,crowd,tile", [(64, 16384, 256, 2048), (64, 60, 20, 32), (20, 100, 10, 64), (3, 50, 10, 40)])
def test_against_all_pairs(spark, monkeypatch, size, leaf, crowd, tile):
    monkeypatch.setattr(embeddings, "LEAF_ROWS", leaf)
    monkeypatch.setattr(embeddings, "CROWD", crowd)
    monkeypatch.setattr(embeddings, "TILE", tile)
    rows = made(600, size, size)
    rows += [(5000, None), (5001, []), (5002, [0.0] * size), (5003, [1.0, None] + [0.0] * (size - 2)), (5004, [float("nan")] * size)]
    rows += [(5005, [float("inf")] + [1.0] * (size - 1)), (None, rows[0][1]), (5006, rows[0][1]), (5007, [1e-200] * size), (5008, [1e200] * size), (5009, [1.0] * (size + 1))]
    links, label = brute(rows, 0.9)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash")).withColumn("u", F.lit(1))
    found = embeddings.near_vectors(frame).collect()
    assert len(found) == len(rows) and sum(links.values()) > 1000
    assert {r["id"]: r["n_links"] for r in found} == links
    assert {r["id"]: r["component_id"] for r in found} == label
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in found)


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert embeddings.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = embeddings.near_vectors(spark.createDataFrame([(2, [1.0, 0.0]), (1, [1.0, 0.0, 0.0])], schema)).collect()
    assert all(r["kept"] and r["n_links"] == 0 for r in rows)
    same = embeddings.near_vectors(spark.createDataFrame([(k, [1.0, 1.0]) for k in range(50)], schema)).collect()
    assert all(r["n_links"] == 49 and r["component_id"] == 0 for r in same)
