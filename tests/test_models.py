"""Trained models against brute force or hand-worked values on small fixtures."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import DCT, NGram, PolynomialExpansion, StringIndexer, Tokenizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from loomframe.functions import text as T, vectors as V
from loomframe.operators import clustering as clu, features as feats, recommend as rec, selection as sel, supervised as sup
from loomframe.operators.stages import apply, chain, check_grid, fitted
from loomframe.sources import models


def ratings(spark, seed=1):
    rng = random.Random(seed)
    rows = [(u, i, float(rng.randrange(1, 6))) for u in range(30) for i in range(20) if rng.random() < 0.5]
    rows += [(0, i % 20, 3.0) for i in range(400)]
    return rec.ratings(spark.createDataFrame(rows, "u int, i int, r double"), "u", "i", "r")


def test_repeated_ratings_are_averaged(spark):
    df = ratings(spark)
    assert df.count() == df.select("user", "item").distinct().count()
    assert df.filter("user = 0").count() <= 20


def test_top_n_is_the_true_top_n(spark):
    model = rec.train(ratings(spark), seed=5, rank=4, iterations=4)
    users = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    got = {}
    for r in rec.items_for_users(model, 3).orderBy("user", "rank").collect():
        got.setdefault(r["user"], []).append(r["rating"])
    for user, scores in got.items():
        best = sorted((float(users[user] @ v) for v in items.values()), reverse=True)[:3]
        assert scores == pytest.approx(best, abs=1e-4)
    assert set(got) == set(users)
    some = spark.createDataFrame([(3,), (4,)], "user int")
    assert {r["user"] for r in rec.items_for_users(model, 3, some).collect()} == {3, 4}


def test_same_seed_same_factors(spark):
    df = ratings(spark)
    first, second = (rec.train(df, seed=5, rank=3, iterations=2).userFactors.orderBy("id").collect() for _ in range(2))
    for a, b in zip(first, second):
        assert list(a["features"]) == pytest.approx(list(b["features"]), abs=1e-5)


def test_ridge_and_lasso_closed_forms(spark):
    xs = [float(i % 7 + 1) for i in range(70)]
    ys = [2.0 * x + (i % 3) for i, x in enumerate(xs)]
    df = spark.createDataFrame([(Vectors.dense([x]), y) for x, y in zip(xs, ys)], ["features", "label"])
    xy, xx = np.mean(np.multiply(xs, ys)), np.mean(np.square(xs))
    weight = lambda stage: float(fitted(stage, df).coefficients[0])
    assert weight(sup.least_squares("label")) == pytest.approx(xy / xx, rel=1e-6)
    assert weight(sup.lasso("label", 0.5)) == pytest.approx((xy - 0.5) / xx, rel=1e-4)
    assert weight(sup.ridge("label", float(np.std(ys)), 0.5)) == pytest.approx(xy / (xx + 0.5), rel=1e-4)


def test_squared_loss_booster_separates(spark):
    df = spark.createDataFrame([(Vectors.dense([float(i)]), float(i > 30)) for i in range(60)], ["features", "label"])
    scored = sup.SquaredLossBooster(1, depth=2, rounds=3).fit(df).transform(df)
    assert scored.filter("prediction <> label").count() <= 2


def test_power_iteration_separates_the_two_parts(spark):
    rows = [(0, 1, 1.0), (0, 2, 1.0), (1, 2, 1.0), (3, 4, 1.0), (4, 0, 0.1)]
    edges = clu.undirected_edges(spark.createDataFrame(rows, "s long, d long, w double"), "s", "d", "w")
    parts = {r["id"]: r["cluster"] for r in clu.communities(edges, 2, 10).collect()}
    assert parts[0] == parts[1] == parts[2] != parts[3] == parts[4]


def test_sparse_vectors_round_trip(spark):
    long = spark.createDataFrame([(1, 0, 2.0), (1, 3, 1.0), (1, 3, 0.5), (2, 1, 4.0)], "id int, pos int, value double")
    vectors = V.sparse_vectors(long, "id", "pos", "value", 5)
    assert {r["id"]: r["features"] for r in vectors.collect()} == {
        1: Vectors.sparse(5, [0, 3], [2.0, 1.5]),
        2: Vectors.sparse(5, [1], [4.0]),
    }
    back = V.explode_vector(vectors, ["id"], "features", dense=False)
    assert {tuple(r) for r in back.collect()} == {(1, 0, 2.0), (1, 3, 1.5), (2, 1, 4.0)}


def test_tokens_and_bigrams(spark):
    df = spark.createDataFrame([(0, "Hi I heard about Spark"), (1, "Logistic,regression,models  ")], "id int, sentence string")
    words = apply(Tokenizer(inputCol="sentence", outputCol="words"), df)
    own = words.withColumn("own", T.token_array("sentence"))
    assert own.filter("words <> own").count() == 0
    grams = apply(NGram(n=2, inputCol="words", outputCol="g"), words).orderBy("id").collect()
    assert grams[0]["g"] == ["hi i", "i heard", "heard about", "about spark"] and grams[1]["g"] == []


def test_han_text_is_cut_to_characters(spark):
    df = spark.createDataFrame([("利润 up 10%",)], "s string")
    row = apply(T.han_bigram_stages("s"), df).first()
    assert row["tokens"] == ["利", "润", "up", "10"] and row["bigrams"][0] == "利 润"


def test_polynomial_order_and_cosine_transform(spark):
    df = spark.createDataFrame([(Vectors.dense([2.0, 3.0]),)], ["f"])
    assert list(apply(PolynomialExpansion(degree=3, inputCol="f", outputCol="p"), df).first()["p"]) == [2, 4, 8, 3, 6, 12, 9, 18, 27]
    waves = apply(DCT(inputCol="f", outputCol="w"), df).first()["w"]
    assert list(waves) == pytest.approx([5 / math.sqrt(2), -1 / math.sqrt(2)])


def test_full_one_hot_keeps_a_slot_for_unseen_values(spark):
    seen = spark.createDataFrame([("b", 1.0), ("a", 2.0)], "c string, x double")
    model = fitted(feats.one_hot_full(["c"], numeric=["x"]), seen)
    rows = model.transform(spark.createDataFrame([("a", 5.0), ("zzz", 6.0)], "c string, x double"))
    assert [list(r["features"].toArray()) for r in rows.orderBy("x").collect()] == [[1, 0, 5], [0, 0, 6]]


def test_stray_grid_parameters_are_refused(spark):
    used, unused = LogisticRegression(), LogisticRegression()
    with pytest.raises(ValueError, match="maxIter"):
        check_grid(chain(used), sel.grid({unused.maxIter: [1, 2]}))
    check_grid(chain(used), sel.grid({used.maxIter: [1, 2], used.regParam: [0.1]}))


def test_folds_do_not_depend_on_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    one, many = (sel.with_folds(df.repartition(n), "k", 4).orderBy("k").collect() for n in (1, 13))
    assert one == many and {r["fold"] for r in one} == {0, 1, 2, 3}


def test_saved_stages_score_alike(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c string, x double")
    model = fitted(chain(StringIndexer(inputCol="c", outputCol="i")), df)
    back = models.load_fitted(models.save(model, str(tmp_path / "m")))
    assert back.transform(df).collect() == model.transform(df).collect()


def test_stop_word_list_is_the_one_spark_uses(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert T.ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_empty_vectors_do_not_break_the_long_form(spark):
    df = spark.createDataFrame([(1, Vectors.sparse(4, [], []))], ["id", "v"])
    assert V.explode_vector(df, ["id"], "v", dense=False).count() == 0
    assert V.explode_vector(df, ["id"], "v").agg(F.sum("value")).first()[0] == 0.0


def test_tree_and_centre_rows(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.clustering import KMeans

    df = spark.createDataFrame([(Vectors.dense([float(i)]), float(i > 3)) for i in range(8)], ["features", "label"])
    rows = sup.tree_rows(spark, DecisionTreeClassifier(maxDepth=1, seed=1).fit(df)).collect()
    assert [(r["depth"], r["rule"].split(" ")[0]) for r in rows] == [(0, "If"), (1, "Predict:"), (0, "Else"), (1, "Predict:")]
    centres = sup.centre_rows(spark, KMeans(k=2, seed=1).fit(df))
    assert sorted(r["value"] for r in centres.collect()) == [1.5, 5.5]


def test_one_pair_and_unknown_pair(spark):
    model = rec.train(ratings(spark), seed=5, rank=3, iterations=2)
    assert rec.score_pair(model, 0, 1) is not None
    assert rec.score_pair(model, 0, 10_000) is None


def test_responsibilities_compute_each_log_once(spark):
    """the expression grew with the square of the components, so that checking a mixture took longer than fitting it."""
    shapes = [(0, 0.5, [0.0, 0.0], [1.0, 0.0, 0.0, 1.0]), (1, 0.3, [4.0, 1.0], [2.0, 0.5, 0.5, 1.0]), (2, 0.2, [-3.0, 2.0], [0.5, 0.1, 0.1, 3.0])]
    parts = spark.createDataFrame(shapes, "component int, weight double, mean array<double>, covariance array<double>")
    rows = [[0.0, 0.0], [3.0, 1.5], [-2.0, 2.0], [1e4, -1e4]]
    df = spark.createDataFrame([(Vectors.dense(r),) for r in rows], ["features"]).select("features", clu.responsibilities(parts, "features").alias("p"))
    for x, row in zip(rows, df.collect()):
        logs = []
        for _, weight, mean, cov in shapes:
            cov = np.array(cov).reshape(2, 2)
            gap = np.array(x) - mean
            logs.append(np.log(weight) - np.log(np.linalg.det(cov)) / 2 - gap @ np.linalg.solve(cov, gap) / 2)
        expected = np.exp(np.array(logs) - max(logs))
        assert row["p"] == pytest.approx((expected / expected.sum()).tolist(), abs=1e-9)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("vector_to_array") + plan.count("UDF(features") <= 2, plan


def test_iterations_leave_no_shuffles_behind(spark):
    """F16: the exchanges of all iterations between two checkpoints lay on disk at once, for several fits at a time."""
    rows = ratings(spark).persist()
    rows.count()
    status = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    left, errors = {}, {}
    for every in (1, 5):
        before = status.size()
        model = fitted(rec.recommender(5, rank=3, iterations=5, checkpoint=every), rows)
        left[every] = status.size() - before
        errors[every] = model.transform(rows).agg(F.avg((F.col("prediction") - F.col("rating")) ** 2)).first()[0]
    rows.unpersist()
    assert left[1] <= left[5] - 6
    assert errors[1] == pytest.approx(errors[5], rel=1e-5)


def test_pairs_are_dealt_once_by_user_and_once_by_item(spark):
    model = rec.train(ratings(spark), seed=5, rank=3, iterations=2)
    pairs = spark.createDataFrame([(0, 1), (0, 1), (3, 2), (0, 10_000), (10_000, 1)], "user long, item long")
    own = getattr(rec, "predicted", lambda pairs, model: rec.with_factor_score(model.transform(pairs), model))
    options = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        found = own(pairs, model)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    want = {(r["user"], r["item"]): r["prediction"] for r in model.transform(pairs).collect()}
    assert sorted((r["user"], r["item"]) for r in rows) == [(0, 1), (0, 1), (3, 2)]
    assert all(r["prediction"] == want[r["user"], r["item"]] and r["score"] == pytest.approx(r["prediction"], rel=1e-5) for r in rows)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert len(dealt) == 4  # pairs and factors, by user and by item
