"""Statistics and evaluation."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loomframe.functions import vectors as V
from loomframe.operators import evaluation as ev, statistics as st
from loomframe.operators.stages import apply
from loomframe.queries.registry import query, r6, table

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
NUMERIC_SQL = ", ".join(NUMERIC)


def _numeric(spark, sf):
    lines = table(spark, sf, "lineitem").select(*NUMERIC)
    return apply(VectorAssembler(inputCols=NUMERIC, outputCol="features"), lines).select("features")


@query(
    "stat_corr_pearson",
    f"""WITH u AS (SELECT l_orderkey, row_number() OVER () AS r, [{NUMERIC_SQL}] AS x FROM lineitem),
             p AS (SELECT unnest(range(4)) AS i), q AS (SELECT unnest(range(4)) AS j)
        SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(corr(x[i + 1], x[j + 1]), 6) + 0.0 AS value
        FROM u, p, q GROUP BY 1, 2""",
)
def corr_pearson(spark, sf):
    return st.correlation(_numeric(spark, sf), "features").withColumn("value", r6("value"))


@query(
    "stat_corr_spearman",
    f"""WITH k AS (SELECT {", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in NUMERIC)}
                   FROM lineitem),
             u AS (SELECT [{NUMERIC_SQL}] AS x FROM k),
             p AS (SELECT unnest(range(4)) AS i), q AS (SELECT unnest(range(4)) AS j)
        SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(corr(x[i + 1]::DOUBLE, x[j + 1]::DOUBLE), 6) + 0.0 AS value
        FROM u, p, q GROUP BY 1, 2""",
)
def corr_spearman(spark, sf):
    return st.rank_correlations(table(spark, sf, "lineitem"), NUMERIC).withColumn("value", r6("value"))


@query(
    "stat_chisq_test",
    """WITH t AS (SELECT l_linestatus AS y, unnest([0, 1, 2]) AS pos,
                         unnest([l_linenumber::VARCHAR, l_returnflag, l_discount::VARCHAR]) AS x FROM lineitem),
            o AS (SELECT pos, x, y, count(*) AS n FROM t GROUP BY ALL),
            xs AS (SELECT pos, x, sum(n) AS nx FROM o GROUP BY ALL), ys AS (SELECT pos, y, sum(n) AS ny FROM o GROUP BY ALL),
            g AS (SELECT pos, x, y, nx, ny, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY pos) AS total
                  FROM xs JOIN ys USING (pos) LEFT JOIN o USING (pos, x, y))
       SELECT CAST(pos AS INTEGER) AS feature, CAST((count(DISTINCT x) - 1) * (count(DISTINCT y) - 1) AS BIGINT) AS dof,
              round(sum((n - nx * ny / total) ** 2 / (nx * ny / total)), 6) + 0.0 AS statistic FROM g GROUP BY 1""",
)
def chisq_test(spark, sf):
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("label"),
        V.dense_vector(["l_linenumber", flag, "l_discount"]).alias("features"),
    )
    tested = st.independence(lines, "features", "label")
    return tested.select(
        F.col("featureIndex").alias("feature"), F.col("degreesOfFreedom").cast("bigint").alias("dof"), r6("statistic").alias("statistic")
    )


LABELLED_SQL = """t AS (SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS y, l_extendedprice AS s,
                         CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS hard FROM lineitem)"""


def _scored(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("y"),
        F.col("l_extendedprice").alias("s"),
        F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("hard"),
    )


@query(
    "eval_binary_auc",
    f"""WITH {LABELLED_SQL}, r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS k FROM t),
             p AS (SELECT sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS q FROM t),
             h AS (SELECT (avg(hard) FILTER (y = 1) + 1 - avg(hard) FILTER (y = 0)) / 2 AS area FROM t)
        SELECT 'score' AS input, round((sum(k) FILTER (y = 1) - max(p) * (max(p) + 1) / 2) / (max(p) * max(q)), 8) AS area_under_roc FROM r, p
        UNION ALL SELECT 'label', round(area, 8) FROM h""",
)
def binary_auc(spark, sf):
    rows = _scored(spark, sf)
    by_score = ev.area_under_roc(rows, "s", "y").withColumn("input", F.lit("score"))
    by_label = ev.area_under_roc(rows, "hard", "y").withColumn("input", F.lit("label"))
    both = by_score.unionByName(by_label)
    return both.select("input", F.round("area_under_roc", 8).alias("area_under_roc"))


CLASSES_SQL = """t AS (SELECT CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0 ELSE 2.0 END AS y,
                         CASE WHEN l_quantity > 33 THEN 2.0::DOUBLE WHEN l_quantity > 16 THEN 1.0 ELSE 0.0 END AS p FROM lineitem),
                 l AS (SELECT DISTINCT y AS label FROM t),
                 m AS (SELECT label, count(*) FILTER (y = label)::DOUBLE AS actual, count(*) FILTER (p = label)::DOUBLE AS predicted,
                              count(*) FILTER (y = label AND p = label)::DOUBLE AS hits, count(*)::DOUBLE AS total FROM t, l GROUP BY 1),
                 k AS (SELECT *, hits / actual AS tpr, (predicted - hits) / (total - actual) AS fpr,
                              CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS prec FROM m),
                 f AS (SELECT *, CASE WHEN prec + tpr > 0 THEN 2 * prec * tpr / (prec + tpr) ELSE 0 END AS f1 FROM k)"""


def _classes(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("y"),
        F.when(F.col("l_quantity") > 33, 2.0).when(F.col("l_quantity") > 16, 1.0).otherwise(0.0).alias("p"),
    )


@query(
    "eval_multiclass",
    f"""WITH {CLASSES_SQL} SELECT CAST(sum(actual) AS BIGINT) AS n, round(sum(hits) / sum(actual), 8) AS accuracy,
        round(sum(prec * actual) / sum(actual), 8) AS weighted_precision, round(sum(tpr * actual) / sum(actual), 8) AS weighted_recall,
        round(sum(f1 * actual) / sum(actual), 8) AS weighted_f1 FROM f""",
)
def multiclass(spark, sf):
    row = ev.multiclass_metrics(_classes(spark, sf), "y", "p")
    names = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1"]
    return row.select("n", *[F.round(c, 8).alias(c) for c in names])


@query("eval_test_error", f"WITH {CLASSES_SQL} SELECT round(avg(CASE WHEN y = p THEN 0.0 ELSE 1.0 END), 8) AS test_error FROM t")
def test_error(spark, sf):
    return ev.multiclass_metrics(_classes(spark, sf), "y", "p").select(F.round("test_error", 8).alias("test_error"))


@query(
    "eval_by_label",
    f"""WITH {CLASSES_SQL} SELECT label, CAST(actual AS BIGINT) AS actual, round(fpr, 8) AS fpr, round(tpr, 8) AS tpr,
        round(prec, 8) AS "precision", round(tpr, 8) AS recall, round(f1, 8) AS f1 FROM f""",
)
def by_label(spark, sf):
    rows = ev.label_metrics(_classes(spark, sf), "y", "p")
    names = ["fpr", "tpr", "precision", "recall", "f1"]
    return rows.select("label", "actual", *[F.round(c, 8).alias(c) for c in names])


@query(
    "eval_regression",
    """WITH t AS (SELECT l_extendedprice AS y, 2000 * l_quantity AS p FROM lineitem)
       SELECT count(*) AS n, round(avg((y - p) ** 2) / 1e6, 6) AS mse, round(sqrt(avg((y - p) ** 2)), 4) AS rmse,
              round(avg(abs(y - p)), 4) AS mae, round(1 - avg((y - p) ** 2) / var_pop(y), 8) AS r2 FROM t""",
)
def regression(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), (2000 * F.col("l_quantity")).alias("p"))
    row = ev.regression_metrics(lines, "y", "p")
    return row.select(
        "n",
        F.round(F.col("mse") / 1e6, 6).alias("mse"),
        F.round("rmse", 4).alias("rmse"),
        F.round("mae", 4).alias("mae"),
        F.round("r2", 8).alias("r2"),
    )


@query(
    "eval_silhouette",
    """WITH e AS (SELECT vec_id, label, embedding FROM embeddings),
            d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, a.vec_id = b.vec_id AS same,
                         list_sum([(a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2 FOR i IN range(1, 65)]) AS q FROM e a, e b),
            m AS (SELECT vec_id, la, lb, CASE WHEN la = lb THEN sum(q) / (count(*) - 1) ELSE avg(q) END AS q FROM d GROUP BY 1, 2, 3),
            s AS (SELECT vec_id, min(q) FILTER (la = lb) AS a, min(q) FILTER (la <> lb) AS b FROM m GROUP BY 1)
       SELECT round(avg((b - a) / greatest(a, b)), 6) + 0.0 AS silhouette FROM s""",
)
def silhouette(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        V.array_vector("embedding").alias("features"), F.col("label").cast("double").alias("cluster")
    )
    value = ev.silhouette(rows, "features", "cluster")
    return spark.createDataFrame([(round(value, 6) + 0.0,)], "silhouette double")


CURVE_SQL = f"""WITH {LABELLED_SQL}, g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM t GROUP BY 1),
                c AS (SELECT s, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
                             sum(pos) OVER () AS p, sum(neg) OVER () AS q FROM g)"""


@query(
    "eval_roc_curve",
    f"""{CURVE_SQL} SELECT s AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, fp::DOUBLE / q::DOUBLE AS fpr,
        tp::DOUBLE / p::DOUBLE AS tpr, tp::DOUBLE / (tp + fp)::DOUBLE AS "precision", (2 * tp)::DOUBLE / (tp + fp + p)::DOUBLE AS f1
        FROM c""",
)
def roc_curve(spark, sf):
    points = ev.threshold_table(_scored(spark, sf), "s", "y")
    return points.select("threshold", "tp", "fp", "fpr", "tpr", "precision", "f1")
