import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loomframe.llm import merkle, queries


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """``(root, the siblings of each leaf level by level)``."""
    proofs = [[] for _ in leaves]
    under = [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        above, held = [], []
        for k in range(0, len(leaves), 2):
            run = leaves[k : k + 2]
            for j, _ in enumerate(run):
                for i in under[k + j]:
                    proofs[i] += run[:j] + run[j + 1 :]
            above.append(sha(*run))
            held.append([i for u in under[k : k + 2] for i in u])
        leaves, under = above, held
    return leaves[0], proofs


def fold(digest, leaves, i):
    """The root that a digest in the i-th place leads to."""
    leaves = [*leaves]
    leaves[i] = digest
    while len(leaves) > 1:
        i //= 2
        leaves = [sha(*leaves[k : k + 2]) for k in range(0, len(leaves), 2)]
    return leaves[0]


def brute(rows, cheap=False):
    """The query's rows from (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: sha(*map(field, r))
    low = lambda x: (x is not None, x or 0) if not isinstance(x, str) else (True, x.encode())
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=low)
    ordered = {g: sorted(groups[g], key=lambda r: (low(r[0]), leaf(r))) for g in langs}
    trees = {g: tree([leaf(r) for r in ordered[g]]) for g in langs}
    subroots = [trees[g][0] for g in langs]
    root, above = tree(subroots)
    out = []
    for t, g in enumerate(langs):
        for i, r in enumerate(ordered[g]):
            wrong = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            start = leaf((*r[:3], r[3] + 1, r[4])) if wrong else leaf(r)
            folded = root if not wrong else fold(fold(start, [leaf(x) for x in ordered[g]], i), subroots, t)
            out.append((r[0], leaf(r), subroots[t], root, sha(*trees[g][1][i], *above[t]), folded, folded == root))
    return sorted(out, key=str)


def asked(spark, rows, folder):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    frame = spark.createDataFrame(rows, schema).withColumns({"tree": F.lit("clash"), "key": F.lit(1), "digest": F.lit(2)})
    frame.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    found = queries.op12_merkle_manifest(spark, str(folder))
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.columns == columns
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=str)


def test_small_and_odd_rows(spark, tmp_path):
    rows = [(i, "s", "de", 5, f"text {i}") for i in range(9)]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (3, "s", "", 0, ""), (14, "é", "é", None, "x")]
    rows += [(7, "s", "en", 3, "abc")] * 5 + [(7, "s", "en", 3, "abd"), (-1, "s", "en", 2**40, "a\x00b")]
    assert asked(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 256, 257, 513])
def test_sizes_around_a_block(spark, tmp_path, n):
    rows = [(i, "s", "en", i, "t" * (i % 5)) for i in range(n)]
    assert asked(spark, rows, tmp_path) == brute(rows)


def test_many_groups_and_equal_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "SHARE", 16)
    monkeypatch.setattr(merkle, "CLIMB", merkle.CLIMB.replace("/ 4096", "/ 16"))
    draw = random.Random(5)
    rows = [(i, "s", f"g{draw.randrange(300)}", i, "t") for i in range(900)] + [(5, "s", "hot", 1, "same")] * 700
    assert asked(spark, rows, tmp_path) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert asked(spark, [], tmp_path) == []


def test_row_limit_is_put_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    asked(spark, [(1, "s", "en", 1, "t")], tmp_path)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted((tuple(r) for r in queries.op12_merkle_manifest(spark, sf).collect()), key=str) == brute(rows)
