"""Term tables and rank correlations on small frames."""

import math

import pytest
from pyspark.ml.feature import StringIndexer

from loomframe.operators import features as ops, statistics as st


def test_term_counts_and_weights(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, []), (4, None)], "id int, w array<string>")
    counted = {tuple(r) for r in ops.term_counts(rows, "id", "w").collect()}
    assert counted == {(1, "a", 2.0, 1), (1, "b", 1.0, 2), (2, "b", 1.0, 2), (2, "c", 1.0, 1)}
    assert {r["term"] for r in ops.term_counts(rows, "id", "w", min_df=2).collect()} == {"b"}
    given = spark.createDataFrame([("c",), ("a",), ("a",), ("z",)], "term string")
    assert {(r["id"], r["term"]) for r in ops.term_counts(rows, "id", "w", vocabulary=given).collect()} == {(1, "a"), (2, "c")}
    weights = {(r["id"], r["term"]): r["weight"] for r in ops.term_weights(rows, "id", "w").collect()}
    assert weights[1, "a"] == pytest.approx(2 * math.log(5 / 2)) and weights[2, "b"] == pytest.approx(math.log(5 / 3))


def test_value_index_is_the_built_in_one(spark):
    rows = [(k, f"v{(k * k) % 37:02d}") for k in range(500)] + [(900 + k, "hot") for k in range(300)] + [(2000, None)]
    df = spark.createDataFrame(rows, "id int, v string")
    index = ops.value_index(df, "v")
    own = {r["id"]: r["i"] for r in ops.with_index(df, "v", index, "i", missing="null").collect()}
    known = df.where("v IS NOT NULL")
    built = {r["id"]: r["i"] for r in StringIndexer(inputCol="v", outputCol="i").fit(known).transform(known).collect()}
    assert own == {**built, 2000: None}
    hot = ops.hot_rows(ops.with_index(known, "v", index, "i"), "id", "i", index.count()).collect()
    last = max(built.values())
    assert {(r["id"], r["pos"]) for r in hot} == {(k, int(i)) for k, i in built.items() if i < last}
    with pytest.raises(Exception, match="no dictionary entry"):
        ops.with_index(df.where("v IS NOT NULL"), "v", index.where("value <> 'hot'"), "i").collect()


def test_rank_correlations_with_a_shared_value(spark):
    rows = [(0.0 if k % 3 else float(k), float((k * 7) % 50), float(-k)) for k in range(300)]

    def ranks(column):
        order = sorted(column)
        return [order.index(x) + (order.count(x) + 1) / 2 for x in column]

    def corr(x, y):
        mx, my = sum(x) / len(x), sum(y) / len(y)
        top = sum((a - mx) * (b - my) for a, b in zip(x, y))
        return top / math.sqrt(sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y))

    columns = [ranks(c) for c in zip(*rows)]
    found = {(r["i"], r["j"]): r["value"] for r in st.rank_correlations(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert len(found) == 9
    for (i, j), value in found.items():
        assert value == pytest.approx(corr(columns[i], columns[j]))


def test_term_counts_are_shuffled_once_for_both_uses(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"])], "id int, w array<string>")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ops.term_counts(rows, "id", "w", min_df=2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in plan
