"""Pairs of rows behind the links of a set join, against all pairs of rows."""

import itertools
import random

import pytest

import __spark_entry__ as contract
from loomframe.operators import setjoin
from loomframe.operators.setjoin import Similarity


def brute(rows, numerator, denominator):
    sets = [(i, frozenset(t or [])) for i, t in rows if i is not None]
    firsts = {s: (min(i for i, x in sets if x == s), sum(x == s for _, x in sets)) for _, s in sets}
    found = []
    for (i, x), (j, y) in itertools.combinations(sets, 2):
        if x == y or denominator * len(x & y) >= numerator * len(x | y):
            a, b = sorted([(i, *firsts[x], len(x)), (j, *firsts[y], len(y))])
            found.append((a[0], b[0], a[1], b[1], a[2], b[2], a[3], b[3], len(x & y)))
    return sorted(found)


@pytest.mark.parametrize("tile", [2, 256])
def test_all_pairs_of_rows(spark, monkeypatch, tile):
    monkeypatch.setattr(setjoin, "TILE_ROWS", tile)
    draw, rows = random.Random(3), []
    for base in range(6):
        words = [f"w{base}-{k}" for k in range(20)]
        near = [words, words[1:], [*words, f"x{base}"]]
        rows += [(draw.randrange(200), draw.choice(near)) for _ in range(12)]
    rows += [(7, ["one"])] * 9 + [(300, None), (301, []), (302, []), (None, ["one"]), (303, ["alone"])]
    frame = spark.createDataFrame(rows, "id long, tokens array<string>")
    found = setjoin.similar_sets(frame, Similarity(4, 5)).row_pairs()
    assert found.columns == ["id_a", "id_b", "first_a", "first_b", "n_a", "n_b", "size_a", "size_b", "shared"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 4, 5)


def test_no_pairs_of_an_empty_table(spark):
    assert setjoin.similar_sets(spark.createDataFrame([], "id long, tokens array<string>"), Similarity(4, 5)).row_pairs().count() == 0


def test_near_duplicate_documents_are_named(spark, tmp_path):
    """Documents 2 and 3 are copies and 4 is near both: each of the three pairs is a row."""
    text = "one two three four five six seven eight nine ten"
    rows = [(2, text), (3, text), (4, f"{text} eleven"), (5, "another text")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = contract.queries()["lsh_minhash_join"](spark, str(tmp_path)).select("id_a", "id_b", "distance")
    assert sorted(tuple(r) for r in found.collect()) == [(2, 3, 0.0), (2, 4, 0.090909), (3, 4, 0.090909)]
