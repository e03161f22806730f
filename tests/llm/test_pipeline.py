"""The pipeline's stages against plain versions, and the queries' contract."""

import importlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from loomframe.llm import queries
from loomframe.session import materialise
from tests.llm.test_quality import Plain
from tests.llm.test_similar import brute

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = materialise(corpus_pipeline.quality_stage(spark, docs, SF), "quality")
    assert kept.columns == columns
    before, after = docs.count(), kept.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in kept.collect()}
    good = [i for i, q in labels.items() if q]
    assert before * 0.7 < after <= before and sum(i in left for i in good) >= 0.97 * len(good)

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    label, _, links = brute(rows, 5, 4, 5)
    single = materialise(corpus_pipeline.copies_stage(spark, kept, SF), "copies")
    assert single.columns == columns and links
    assert {r["doc_id"] for r in single.collect()} == {i for i, c in label.items() if i == c}

    mixed = materialise(corpus_pipeline.mix_stage(spark, single, SF), "mix")
    assert mixed.columns == columns
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in single.collect()}
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert max(times.values()) <= 2 and set(times) <= set(size)
    assert sum(size[i] * n for i, n in times.items()) == pytest.approx(1.5 * sum(size.values()), rel=0.2)

    import public_tokenizers
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    last = corpus_pipeline.tokens_stage(spark, mixed, SF).collect()
    assert len(last) == sum(times.values())
    assert all(r["ids"] == own.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in last)


def test_stages_take_odd_tables(spark, docs):
    odd = docs([(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x y"), (4, "w " * 5000), (5, "a b c", None, None)])
    for frame, least in ((docs([]), 0), (odd, 1)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = materialise(stage(spark, frame, SF), "odd")
            assert frame.count() >= least
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() == frame.count()


def test_run_keeps_the_order_of_the_curriculum(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows) and {r["copy"] for r in rows} <= {0, 1}
    first = sorted({r["source"] for r in rows})[0]
    mine = [r["n_tokens"] * (r["position"] < 0.5) for r in rows if r["source"] == first]
    # The first source's weight falls from 3 to 1: five eighths of it come in the first half.
    assert sum(mine) / sum(r["n_tokens"] for r in rows if r["source"] == first) == pytest.approx(5 / 8, abs=0.1)


def test_mixing_query_is_in_order(spark):
    taken = [r["taken"] > 0 for r in queries.QUERIES["op8_source_mixing"](spark, SF).collect()]
    assert 0 < sum(taken) and all(taken[: sum(taken)])


def test_every_operator_has_a_query():
    contract = importlib.import_module("__spark_entry__")
    names = contract.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(queries.ORACLES) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    frame = queries.QUERIES[name](spark, SF)
    want = db.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(frame.columns)
    key = lambda rows: sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows)
    assert key(tuple(r) for r in frame.select(*names).collect()) == key(want.fetchall())


def test_plain_model_is_used():
    assert Plain(["a a b", "a b"]).known == {b"a", b"b"}
