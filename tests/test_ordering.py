import random

import pytest

from loomframe.operators import ordering, relational as rel, statistics as st


def one_column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def skewed(n=3000, seed=5):
    rng = random.Random(seed)
    return [7.0 if rng.random() < 0.4 else float(rng.randrange(500)) for _ in range(n)]


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_running_totals_match_a_plain_loop(spark, ascending, ranges):
    values = skewed()
    counted = ordering.value_counts(one_column(spark, values), "x")
    rows = ordering.running_totals(counted, "x", ["n"], ascending, ranges).collect()
    total, expected = 0, {}
    for v in sorted(set(values), reverse=not ascending):
        n = values.count(v)
        expected[v] = (total, total + n)
        total += n
    assert {r["x"]: (r["n_before"], r["n_upto"]) for r in rows} == expected


def test_dictionary_is_consecutive_and_ordered(spark):
    words = [f"w{i * 37 % 101:03d}" for i in range(400)] + [None]
    rows = ordering.dictionary(one_column(spark, words, "string"), "x").collect()
    assert {r["x"]: r["index"] for r in rows} == {w: i for i, w in enumerate(sorted({w for w in words if w}))}


def test_exact_quantiles_with_a_hot_value(spark):
    values = skewed()
    got = ordering.exact_quantiles(one_column(spark, values), "x", [0.0, 0.25, 0.5, 0.9, 1.0])
    ranked = sorted(values)
    assert got == [ranked[0], ranked[749], ranked[1499], ranked[2699], ranked[-1]]


def test_quantiles_of_nothing(spark):
    assert ordering.exact_quantiles(one_column(spark, [None, None]), "x", [0.5]) == [None]


def test_rank_correlation_matches_the_matrix_form(spark):
    from pyspark.ml.feature import VectorAssembler

    rng = random.Random(3)
    rows = [(float(a), float(a * a % 17 + rng.randrange(3))) for a in (rng.randrange(20) for _ in range(500))]
    df = spark.createDataFrame(rows, "a double, b double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    whole = st.correlation(vectors, "v", "spearman").filter("i = 0 and j = 1").first()["value"]
    assert st.rank_correlation(df, "a", "b").first()[0] == pytest.approx(whole, abs=1e-12)


def test_top_k_best_first_and_ascending(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("a", "z", 3.0), ("b", "x", 2.0)], "k string, i string, s double")
    best = {r["k"]: [tuple(e) for e in r["top"]] for r in rel.top_k_per_key(df, "k", "s", "i", 2).collect()}
    assert best == {"a": [("y", 3.0), ("z", 3.0)], "b": [("x", 2.0)]}
    worst = {r["k"]: [tuple(e) for e in r["top"]] for r in rel.top_k_per_key(df, "k", "s", "i", 1, ascending=True).collect()}
    assert worst["a"] == [("x", 1.0)]


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 k", "id i", "cast(id as double) s")
    plan = rel.top_k_per_key(df, "k", "s", "i", 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_lookup_modes(spark):
    fact = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    assert {tuple(r) for r in rel.lookup(fact, dim, "k").collect()} == {(1, "one"), (2, None)}
    assert rel.lookup(fact, dim, "k", missing="drop").count() == 1
    with pytest.raises(Exception, match="no dictionary entry for 2"):
        rel.lookup(fact, dim, "k", missing="error").collect()


def test_lookup_is_not_broadcast_beyond_its_bound(spark):
    fact, dim = spark.range(10).withColumnRenamed("id", "k"), spark.range(50).selectExpr("id k", "id * 2 v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda n: rel.lookup(fact, dim, "k", max_rows=n)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(50)
        assert "BroadcastHashJoin" not in plan(49)
        assert rel.lookup(fact, dim, "k", max_rows=49).count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_mean_fill_on_an_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert [r[0] for r in rel.fill_with_mean(df, "x").collect()] == [None, None]
