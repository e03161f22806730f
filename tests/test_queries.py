"""The registry, and the quick queries against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUICK = [
    name
    for name in contract.queries()
    if name.startswith(("rel_", "agg_", "join_pred", "join_broadcast", "sort_", "limit_", "split_", "eval_", "stat_", "fpm_"))
    or name.startswith(("feat_token", "feat_b", "feat_s", "feat_m", "feat_n", "feat_q", "feat_i", "feat_p", "feat_d"))
    and name != "feat_synonyms"
    or name in {"src_csv_header", "src_bad_label_report", "src_text_charset", "lsh_minhash_join", "reg_isotonic", "clf_naive_bayes"}
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def cells(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        return repr(round(v, 9)) if isinstance(v, float) and not math.isnan(v) else repr(v)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 150


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["item", "rank", "other", "confidence"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_matches_sql(spark, db, name):
    frame = contract.queries()[name](spark, SF)
    rows = [tuple(row) for row in frame.collect()]
    result = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert cells(rows, frame.columns) == cells(result.fetchall(), names)
