import random

import pytest

from loomframe.operators import evaluation as ev


def scored(spark, n=800, seed=2, levels=40):
    rng = random.Random(seed)
    rows = [(float(rng.randrange(levels)), int(rng.random() < 0.4)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "s double, y int")


@pytest.mark.parametrize("levels", [2, 40, 100000])
def test_area_matches_pair_counting(spark, levels):
    rows, df = scored(spark, levels=levels)
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    assert ev.area_under_roc(df, "s", "y").first()[0] == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_area_with_one_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "s double, y int")
    assert ev.area_under_roc(df, "s", "y").first()[0] is None


def test_best_threshold(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.7, 0), (0.1, 0)], "s double, y int")
    row = ev.best_threshold(df, "s", "y").first()
    assert (row["threshold"], row["f1"]) == (0.8, 1.0)


def test_label_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (2.0, 2.0)], "y double, p double")
    rows = {r["label"]: r for r in ev.label_metrics(df, "y", "p").collect()}
    assert (rows[1.0]["precision"], rows[1.0]["recall"], rows[1.0]["f1"]) == (0.0, 0.0, 0.0)
    assert rows[0.0]["precision"] == pytest.approx(2 / 3) and rows[0.0]["fpr"] == pytest.approx(0.5)
    whole = ev.multiclass_metrics(df, "y", "p").first()
    assert (whole["n"], whole["accuracy"], whole["test_error"]) == (4, 0.75, 0.25)


def test_multiclass_agrees_with_the_built_in_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(9)
    df = spark.createDataFrame([(float(rng.randrange(4)), float(rng.randrange(4))) for _ in range(500)], "y double, p double")
    row = ev.multiclass_metrics(df, "y", "p").first()
    for ours, theirs in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_f1", "f1")):
        built_in = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=theirs).evaluate(df)
        assert row[ours] == pytest.approx(built_in, abs=1e-12)
