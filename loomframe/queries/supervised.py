"""Classifiers and regressors: closed forms where one exists, else defining properties of the fitted model."""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import (
    AFTSurvivalRegression,
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    IsotonicRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import functions as F

from loomframe.functions import vectors as V
from loomframe.operators import evaluation as ev, features as feats, isotonic as iso, supervised as sup
from loomframe.operators.stages import apply, chain, fitted, stage_of
from loomframe.queries.registry import far, none_broken, query, r6, table, violations
from loomframe.session import bounded

SEED = 17
NUMERIC = ["l_quantity", "l_discount", "l_tax", "price"]


def _lines(spark, sf):
    """Line items with numeric features, a binary label and a three-class label."""
    names = [
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_extendedprice",
    ]
    lines = table(spark, sf, "lineitem").select(
        *names,
        (F.col("l_extendedprice") / 10000).alias("price"),
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("kind"),
    )
    return apply(VectorAssembler(inputCols=NUMERIC, outputCol="features"), lines)


def _dummies(spark, sf):
    """One slot per return flag, so a model without penalty reproduces the group means."""
    flag = lambda v: (F.col("l_returnflag") == v).cast("int")
    return table(spark, sf, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("label"),
        V.dense_vector([flag("A"), flag("N")]).alias("features"),
    )


# ---- classifiers


@query(
    "clf_logistic",
    """SELECT l_returnflag, round(avg(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END), 5) AS p, count(*) AS n FROM lineitem GROUP BY 1""",
)
def logistic(spark, sf):
    rows = _dummies(spark, sf)
    scored = apply(LogisticRegression(maxIter=100, tol=1e-12), rows)
    per = scored.groupBy("l_returnflag").agg(
        F.avg(V.vector_array("probability")[1]).alias("p"), F.count(F.lit(1)).alias("n")
    )
    return per.select("l_returnflag", F.round("p", 5).alias("p"), "n")


@query(
    "clf_logistic_multi",
    """WITH g AS (SELECT l_linestatus, count(*)::DOUBLE AS n, count(*) FILTER (l_returnflag = 'A') AS a,
                         count(*) FILTER (l_returnflag = 'N') AS b, count(*) FILTER (l_returnflag = 'R') AS c FROM lineitem GROUP BY 1)
       SELECT l_linestatus, round(a / n, 5) AS p0, round(b / n, 5) AS p1, round(c / n, 5) AS p2 FROM g""",
)
def logistic_multi(spark, sf):
    rows = _lines(spark, sf).select("l_linestatus", "kind", V.dense_vector(["label"]).alias("features"))
    stage = LogisticRegression(family="multinomial", labelCol="kind", maxIter=100, tol=1e-12)
    p = V.vector_array("probability")
    per = apply(stage, rows).groupBy("l_linestatus").agg(*[F.avg(p[i]).alias(f"p{i}") for i in range(3)])
    return per.select("l_linestatus", *[F.round(f"p{i}", 5).alias(f"p{i}") for i in range(3)])


@query("clf_logistic_summary", none_broken("lineitem"))
def logistic_summary(spark, sf):
    rows = _lines(spark, sf)
    model = fitted(LogisticRegression(maxIter=10, regParam=0.01, elasticNetParam=0.8), rows)
    summary = model.summary
    history = list(summary.objectiveHistory)
    rising = any(b > a + 1e-9 for a, b in zip(history, history[1:]))
    area = summary.areaUnderROC
    exact = ev.area_under_roc(
        summary.predictions.select(V.vector_array("probability")[1].alias("s"), "label"), "s", "label"
    ).first()[0]
    best = summary.fMeasureByThreshold.orderBy(F.desc("F-Measure"), F.desc("threshold")).first()["threshold"]
    model.setThreshold(best)
    scored = model.transform(rows)
    p = V.vector_array("probability")[1]
    wrong = (F.col("prediction") != F.when(p > best, 1.0).otherwise(0.0)) & (F.abs(p - best) > 1e-12)
    return violations(scored, wrong | F.lit(rising) | F.lit(abs(area - exact) > 0.01))


@query("clf_logistic_multi_summary", "SELECT CAST(3 AS BIGINT) AS rows_scored, CAST(0 AS BIGINT) AS violations")
def logistic_multi_summary(spark, sf):
    rows = _lines(spark, sf)
    model = fitted(LogisticRegression(family="multinomial", labelCol="kind", maxIter=10, regParam=0.001), rows)
    reported = sup.label_metrics_of(spark, model.summary)
    counted = ev.label_metrics(model.summary.predictions, "kind", "prediction").select(
        "label", *[F.col(c).alias(f"{c}_counted") for c in ("fpr", "tpr", "precision", "recall", "f1")]
    )
    both = reported.join(counted, "label", "left")
    broken = F.lit(False)
    for name in ("fpr", "tpr", "precision", "recall", "f1"):
        broken = broken | far(F.col(name), F.col(f"{name}_counted"), 1e-9)
    return violations(both, broken)


@query("clf_linear_svc", none_broken("lineitem"))
def linear_svc(spark, sf):
    rows = _lines(spark, sf)
    model = fitted(LinearSVC(maxIter=10, regParam=0.1), rows)
    scored = model.transform(rows).withColumn("w", sup.linear_score(model, "features"))
    raw = V.vector_array("rawPrediction")[1]
    side = F.when(F.col("w") > 0, 1.0).otherwise(0.0)
    return violations(scored, far(raw, F.col("w"), 1e-9) | ((F.col("prediction") != side) & (F.abs("w") > 1e-9)))


@query(
    "clf_naive_bayes",
    """WITH t AS (SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS y, l_quantity AS a, l_linenumber::DOUBLE AS b, l_extendedprice / 10000 AS c FROM lineitem),
            s AS (SELECT y, count(*)::DOUBLE AS n, sum(a) AS a, sum(b) AS b, sum(c) AS c FROM t GROUP BY 1),
            k AS (SELECT count(*)::DOUBLE AS n FROM t)
       SELECT y AS class, round(ln(s.n + 1) - ln(k.n + 2), 6) + 0.0 AS prior, round(ln(a + 1) - ln(a + b + c + 3), 6) + 0.0 AS t0,
              round(ln(b + 1) - ln(a + b + c + 3), 6) + 0.0 AS t1, round(ln(c + 1) - ln(a + b + c + 3), 6) + 0.0 AS t2 FROM s, k""",
)
def naive_bayes(spark, sf):
    rows = _lines(spark, sf).select("label", V.dense_vector(["l_quantity", "l_linenumber", "price"]).alias("features"))
    model = fitted(NaiveBayes(smoothing=1.0), rows)
    pi, theta = model.pi.toArray(), model.theta.toArray()
    out = [(k, float(pi[k]), *[float(x) for x in theta[k]]) for k in range(len(pi))]
    names = ["prior", "t0", "t1", "t2"]
    df = spark.createDataFrame(out, "class int, prior double, t0 double, t1 double, t2 double")
    return df.select("class", *[r6(c).alias(c) for c in names])


@query(
    "clf_tree",
    """WITH t AS (SELECT CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS y, CASE WHEN l_quantity > 20 THEN 1 ELSE 0 END AS x FROM lineitem)
       SELECT x, round(avg(y), 8) AS p, CAST(CASE WHEN avg(y) > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, count(*) AS n FROM t GROUP BY 1""",
)
def tree(spark, sf):
    x = F.when(F.col("l_quantity") > 20, 1).otherwise(0)
    rows = _lines(spark, sf).select(
        x.alias("x"), F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("label"), V.dense_vector([x]).alias("features")
    )
    scored = fitted(DecisionTreeClassifier(maxDepth=1, impurity="gini", seed=SEED), bounded(rows)).transform(rows)
    per = scored.groupBy("x", "prediction").agg(
        F.avg(V.vector_array("probability")[1]).alias("p"), F.count(F.lit(1)).alias("n")
    )
    return per.select("x", F.round("p", 8).alias("p"), "prediction", "n")


def _figure(one):
    """The only number of a table as a literal. Models score with functions that Spark takes for random, so a subquery
    over their scores may not stand inside an aggregate."""
    return F.lit(one.first()[0]).cast("double")


def _consistent(scored, label="kind"):
    """The label is the first largest probability, the probabilities sum to one, and on average they say more about the
    label than its frequencies do: a model that has learnt nothing breaks every row."""
    p = V.vector_array("probability")
    total = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x)
    surprise = _figure(scored.agg(F.avg(-F.log(F.greatest(F.get(p, F.col(label).cast("int")), F.lit(1e-12))))))
    shares = scored.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    known = _figure(shares.agg((F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n"))))
    dull = ~F.coalesce(surprise < known, F.lit(False))
    return violations(scored, (F.col("prediction") != V.argmax(p)) | far(total, F.lit(1.0), 1e-9) | dull)


@query("clf_forest", none_broken("lineitem"))
def forest(spark, sf):
    stage = RandomForestClassifier(labelCol="kind", numTrees=9, maxDepth=5, impurity="gini", seed=SEED)
    rows = _lines(spark, sf).select("kind", "features")
    return _consistent(fitted(stage, bounded(rows)).transform(rows))


@query(
    "clf_gbt",
    """SELECT 'logistic' AS loss, count(*) AS rows_scored, CAST(0 AS BIGINT) AS violations FROM lineitem
       UNION ALL SELECT 'squared', count(*), 0 FROM lineitem""",
)
def gbt(spark, sf):
    """Dear line items by both losses."""
    rows = _lines(spark, sf).withColumn("label", F.when(F.col("price") > 4, 1.0).otherwise(0.0))
    train = bounded(rows.select("label", "features"))
    scored = fitted(GBTClassifier(maxIter=5, maxDepth=3, seed=SEED), train).transform(rows)
    raw = V.vector_array("rawPrediction")[1]
    p = V.vector_array("probability")[1]
    wrong = far(p, 1 / (1 + F.exp(-2 * raw)), 1e-9) | (F.col("prediction") != F.when(raw > 0, 1.0).otherwise(0.0))
    common = rows.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    # No better than the commonest label: nothing learnt.
    learnt = lambda df: df.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > common
    logistic_loss = violations(scored, wrong | F.lit(not learnt(scored))).withColumn("loss", F.lit("logistic"))
    booster = sup.SquaredLossBooster(SEED, depth=3, rounds=5).fit(train)
    squared = booster.transform(rows)
    sign = F.col("prediction") != F.when(F.col("score") > 0, 1.0).otherwise(0.0)
    unsound = sign | (F.abs("score") > 10) | F.lit(not learnt(squared))
    return logistic_loss.unionByName(violations(squared, unsound).withColumn("loss", F.lit("squared")))


@query("clf_mlp", none_broken("lineitem"))
def mlp(spark, sf):
    """Three bands of quantity, which the features tell apart: a perceptron that has learnt nothing shows."""
    stages = chain(
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
        MultilayerPerceptronClassifier(
            featuresCol="scaled", labelCol="kind", layers=[4, 5, 4, 3], blockSize=128, seed=1234, maxIter=20
        ),
    )
    band = F.when(F.col("l_quantity") <= 16, 0.0).when(F.col("l_quantity") <= 33, 1.0).otherwise(2.0)
    return _consistent(apply(stages, _lines(spark, sf).withColumn("kind", band)))


@query("clf_one_vs_rest", none_broken("lineitem"))
def one_vs_rest(spark, sf):
    base = LogisticRegression(maxIter=10, tol=1e-6, fitIntercept=True)
    model = fitted(OneVsRest(classifier=base, labelCol="kind", parallelism=3), _lines(spark, sf))
    rows = _lines(spark, sf)
    scores = F.array(*[sup.linear_score(m, "features") for m in model.models])
    scored = model.transform(rows).withColumn("scores", scores)
    gap = F.array_max("scores") - F.get("scores", F.col("prediction").cast("int"))
    return violations(scored, gap > 1e-9)


# ---- regressors


@query(
    "reg_linear_enet",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
              round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, round(sqrt(regr_syy(l_extendedprice, l_quantity) * (1 - regr_r2(l_extendedprice, l_quantity)) / count(*)), 3) AS rmse,
              count(*) AS n FROM lineitem""",
)
def linear_enet(spark, sf):
    rows = _lines(spark, sf).select(V.dense_vector(["l_quantity"]).alias("features"), "l_extendedprice")
    model = fitted(LinearRegression(labelCol="l_extendedprice", regParam=0.0, elasticNetParam=0.8, maxIter=100, tol=1e-12), rows)
    s = model.summary
    out = (
        round(float(model.coefficients[0]), 3),
        round(float(model.intercept), 2),
        round(s.r2, 6),
        round(s.rootMeanSquaredError, 3),
        int(s.numInstances),
    )
    return spark.createDataFrame([out], "slope double, intercept double, r2 double, rmse double, n bigint")


def _one_feature(spark, sf):
    return _lines(spark, sf).select(V.dense_vector(["l_quantity"]).alias("features"), "l_extendedprice")


def _weight(spark, model):
    return spark.createDataFrame([(round(float(model.coefficients[0]), 4),)], "weight double")


@query("reg_linear", "SELECT round(sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity), 4) AS weight FROM lineitem")
def linear(spark, sf):
    return _weight(spark, fitted(sup.least_squares("l_extendedprice"), _one_feature(spark, sf)))


@query(
    "reg_lasso",
    "SELECT round((avg(l_quantity * l_extendedprice) - 5000) / avg(l_quantity * l_quantity), 4) AS weight FROM lineitem",
)
def lasso(spark, sf):
    return _weight(spark, fitted(sup.lasso("l_extendedprice", penalty=5000.0), _one_feature(spark, sf)))


@query(
    "reg_ridge",
    "SELECT round(avg(l_quantity * l_extendedprice) / (avg(l_quantity * l_quantity) + 100), 4) AS weight FROM lineitem",
)
def ridge(spark, sf):
    rows = _one_feature(spark, sf)
    deviation = rows.agg(F.stddev_pop("l_extendedprice")).first()[0]
    return _weight(spark, fitted(sup.ridge("l_extendedprice", deviation, penalty=100.0), rows))


@query(
    "reg_glm",
    """SELECT 'poisson' AS family, l_returnflag, round(avg(l_quantity), 4) AS mean FROM lineitem GROUP BY 2
       UNION ALL SELECT 'gaussian', l_returnflag, round(avg(l_quantity), 4) FROM lineitem GROUP BY 2""",
)
def glm(spark, sf):
    rows = _dummies(spark, sf)
    parts = []
    for family, link in (("poisson", "log"), ("gaussian", "identity")):
        stage = GeneralizedLinearRegression(labelCol="l_quantity", family=family, link=link, maxIter=25)
        per = apply(stage, rows).groupBy("l_returnflag").agg(F.round(F.avg("prediction"), 4).alias("mean"))
        parts.append(per.select(F.lit(family).alias("family"), "l_returnflag", "mean"))
    return parts[0].unionByName(parts[1])


@query(
    "reg_glm_summary",
    """WITH s AS (SELECT count(*)::DOUBLE AS n, avg(l_quantity) AS mx, regr_sxx(l_extendedprice, l_quantity) AS sxx,
                         regr_sxy(l_extendedprice, l_quantity) AS sxy, regr_syy(l_extendedprice, l_quantity) AS syy,
                         regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
            d AS (SELECT *, syy - sxy * sxy / sxx AS sse FROM s),
            e AS (SELECT *, sse / (n - 2) AS disp, sqrt(sse / (n - 2) / sxx) AS eb, sqrt(sse / (n - 2) * (1 / n + mx * mx / sxx)) AS ea FROM d),
            f AS (SELECT round(disp / 1e6, 4) AS dispersion, CAST(n - 1 AS BIGINT) AS null_dof, CAST(n - 2 AS BIGINT) AS dof,
                         round(sse / syy, 8) AS deviance_share, round(n * (ln(2 * pi() * sse / n) + 1) + 6, 1) AS aic, * FROM e)
       SELECT 'l_quantity' AS name, round(b, 3) AS value, round(eb, 3) AS std_error, round(b / eb, 3) AS t, dispersion, deviance_share, null_dof, dof, aic FROM f
       UNION ALL SELECT '(intercept)', round(a, 3), round(ea, 3), round(a / ea, 3), dispersion, deviance_share, null_dof, dof, aic FROM f""",
)
def glm_summary(spark, sf):
    rows = _lines(spark, sf).select(V.dense_vector(["l_quantity"]).alias("features"), "l_extendedprice")
    stage = GeneralizedLinearRegression(labelCol="l_extendedprice", family="gaussian", link="identity", maxIter=10)
    model = fitted(stage, rows)
    fit = sup.glm_fit(spark, model).first()
    parts = sup.glm_rows(spark, model, ["l_quantity"])
    return parts.select(
        "name",
        *[F.round(c, 3).alias(c) for c in ("value", "std_error", "t")],
        F.lit(round(fit["dispersion"] / 1e6, 4)).alias("dispersion"),
        F.lit(round(fit["deviance"] / fit["null_deviance"], 8)).alias("deviance_share"),
        F.lit(fit["null_dof"]).cast("bigint").alias("null_dof"),
        F.lit(fit["dof"]).cast("bigint").alias("dof"),
        F.lit(round(fit["aic"], 1)).alias("aic"),
    )


@query(
    "reg_tree",
    """WITH t AS (SELECT CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS x, l_extendedprice AS y FROM lineitem)
       SELECT x, round(avg(y), 4) AS prediction, count(*) AS n FROM t GROUP BY 1""",
)
def regression_tree(spark, sf):
    x = F.when(F.col("l_quantity") > 25, 1).otherwise(0)
    rows = _lines(spark, sf).select(x.alias("x"), "l_extendedprice", V.dense_vector([x]).alias("features"))
    stage = DecisionTreeRegressor(labelCol="l_extendedprice", maxDepth=1, impurity="variance", seed=SEED)
    scored = fitted(stage, bounded(rows)).transform(rows)
    return scored.groupBy("x").agg(F.round(F.avg("prediction"), 4).alias("prediction"), F.count(F.lit(1)).alias("n"))


@query("reg_forest", none_broken("lineitem"))
def regression_forest(spark, sf):
    rows = _lines(spark, sf)
    stage = RandomForestRegressor(
        labelCol="l_extendedprice", numTrees=8, featureSubsetStrategy="onethird", maxDepth=6, maxBins=32, seed=SEED
    )
    scored = fitted(stage, bounded(rows.select("l_extendedprice", "features"))).transform(rows)
    low, high = (_figure(rows.agg(end("l_extendedprice"))) for end in (F.min, F.max))
    fit = _figure(ev.regression_metrics(scored, "l_extendedprice", "prediction").select("r2"))
    return violations(scored, (F.col("prediction") < low) | (F.col("prediction") > high) | ~F.coalesce(fit > 0.1, F.lit(False)))


@query("reg_gbt", none_broken("lineitem"))
def regression_gbt(spark, sf):
    """The charge of line items; a model without rounds explains none of it."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    rows = _lines(spark, sf).select(charge.alias("charge"), V.dense_vector(["l_quantity", "price", "l_discount", "l_tax"]).alias("features"))
    scored = fitted(GBTRegressor(labelCol="charge", maxIter=5, maxDepth=4, seed=SEED), bounded(rows)).transform(rows)
    fit = _figure(ev.regression_metrics(scored, "charge", "prediction").select("r2"))
    return violations(scored, F.col("prediction").isNull() | ~F.coalesce(fit > 0.5, F.lit(False)))


@query(
    "reg_isotonic",
    """WITH h AS (SELECT hour(ts)::DOUBLE AS x, sum(value) AS s, count(*)::DOUBLE AS n FROM events GROUP BY 1),
            b AS (SELECT p.x, lo.x AS lo, hi.x AS hi, sum(m.s) / sum(m.n) AS v FROM h p, h lo, h hi, h m
                  WHERE lo.x <= p.x AND hi.x >= p.x AND m.x BETWEEN lo.x AND hi.x GROUP BY 1, 2, 3),
            g AS (SELECT x, lo, min(v) AS v FROM b GROUP BY 1, 2)
       SELECT x, round(max(v), 6) + 0.0 AS prediction FROM g GROUP BY 1""",
)
def isotonic(spark, sf):
    hours = (
        table(spark, sf, "events")
        .groupBy(F.hour("ts").cast("double").alias("x"))
        .agg(F.avg("value").alias("label"), F.count(F.lit(1)).cast("double").alias("n"))
    )
    stage = IsotonicRegression(featuresCol="x", labelCol="label", weightCol="n")
    return apply(stage, hours).select("x", r6("prediction").alias("prediction"))


@query(
    "reg_isotonic_boundaries",
    """WITH h AS (SELECT hour(ts)::DOUBLE AS x, sum(value) AS s, count(*)::DOUBLE AS n FROM events GROUP BY 1),
            b AS (SELECT p.x, lo.x AS lo, hi.x AS hi, sum(m.s) / sum(m.n) AS v FROM h p, h lo, h hi, h m
                  WHERE lo.x <= p.x AND hi.x >= p.x AND m.x BETWEEN lo.x AND hi.x GROUP BY 1, 2, 3),
            g AS (SELECT x, lo, min(v) AS v FROM b GROUP BY 1, 2),
            f AS (SELECT x, round(max(v), 6) + 0.0 AS prediction FROM g GROUP BY 1),
            e AS (SELECT prediction, min(x) AS lo, max(x) AS hi FROM f GROUP BY 1)
       SELECT lo AS boundary, prediction FROM e UNION SELECT hi, prediction FROM e""",
)
def isotonic_boundaries(spark, sf):
    """The ends of the blocks of the mean value by hour, pooled from ranges of all events."""
    events = table(spark, sf, "events").select(F.hour("ts").alias("x"), "value")
    rows = iso.boundary_rows(iso.isotonic_blocks(events, "x", "value"))
    return rows.select("boundary", r6("prediction").alias("prediction"))


@query("reg_aft", none_broken("events"))
def aft(spark, sf):
    events = table(spark, sf, "events")
    rows = events.select(
        (F.col("value") + 0.01).alias("label"),
        F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("censor"),
        V.dense_vector([F.hour("ts"), F.col("user_id") / 100]).alias("features"),
    )
    model = fitted(AFTSurvivalRegression(quantileProbabilities=[0.3, 0.6], quantilesCol="quantiles", maxIter=20), rows)
    centre = F.exp(sup.linear_score(model, "features"))
    q = V.vector_array("quantiles")
    expected = [centre * F.pow(F.lit(-1.0) * F.log(F.lit(1 - p)), F.lit(float(model.scale))) for p in (0.3, 0.6)]
    scored = model.transform(rows)
    # At the largest likelihood the expected events are those observed.
    hazard = F.exp((F.log("label") - F.log(centre)) / F.lit(float(model.scale)))
    events_seen, events_expected = scored.agg(F.sum("censor"), F.sum(hazard)).first()
    learnt = abs(events_seen - events_expected) < 0.02 * events_seen
    broken = far(F.col("prediction"), centre) | far(q[0], expected[0]) | far(q[1], expected[1]) | F.lit(not learnt)
    return violations(scored, broken)


@query(
    "cat_metadata",
    """SELECT 'l_returnflag_index' AS name, 0 AS pos, CAST(count(DISTINCT l_returnflag) AS INTEGER) AS arity FROM lineitem
       UNION ALL SELECT 'l_linestatus_index', 1, CAST(count(DISTINCT l_linestatus) AS INTEGER) FROM lineitem""",
)
def cat_metadata(spark, sf):
    columns = ["l_returnflag", "l_linestatus"]
    stages = chain(
        StringIndexer(inputCols=columns, outputCols=[f"{c}_index" for c in columns]),
        VectorAssembler(inputCols=[*[f"{c}_index" for c in columns], "l_quantity"], outputCol="features"),
    )
    rows = apply(stages, table(spark, sf, "lineitem"))
    return spark.createDataFrame(feats.category_arity(rows, "features"), "name string, pos int, arity int")


@query("model_explain", none_broken("lineitem"))
def model_explain(spark, sf):
    """Scores recomputed from the coefficient table of a stage read out of a fitted chain of stages, a tree's from its
    printed rules, and clusters from the table of centres."""
    rows = _lines(spark, sf)
    stages = chain(
        VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="chosen"),
        LinearRegression(featuresCol="chosen", labelCol="l_extendedprice", regParam=0.3, elasticNetParam=0.8, maxIter=10),
    )
    model = fitted(stages, rows)
    last = stage_of(model, type(model.stages[-1]))
    table_rows = sup.coefficient_rows(spark, last, ["l_quantity", "l_discount"])
    value = lambda name: table_rows.filter(F.col("name") == name).select("value").scalar()
    expected = (
        value("l_quantity") * F.col("l_quantity") + value("l_discount") * F.col("l_discount") + value("(intercept)")
    )
    tree = fitted(DecisionTreeClassifier(labelCol="kind", maxDepth=4, seed=SEED), bounded(rows))
    by_rules = sup.rules_prediction(sup.tree_rows(spark, tree), "features")
    clusters = fitted(KMeans(k=3, maxIter=5, seed=SEED), rows)
    by_centres = sup.nearest_centre(sup.centre_rows(spark, clusters), "features")
    scored = model.transform(rows).withColumn("rules", by_rules).withColumn("nearest", by_centres)
    scored = tree.transform(scored.withColumnRenamed("prediction", "line"))
    scored = clusters.transform(scored.withColumnRenamed("prediction", "leaf"))
    linear = far(F.col("line"), expected, 1e-9)
    return violations(scored, linear | (F.col("leaf") != F.col("rules")) | (F.col("prediction") != F.col("nearest")))
