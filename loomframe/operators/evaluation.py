"""Metrics as one aggregate over predictions."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame, functions as F

from loomframe.operators.ordering import running_totals


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, prediction, n)``: the only pass over the rows that class metrics need."""
    return df.groupBy(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def label_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per label: rows, true and false positive rate, precision, recall, F1."""
    cells = confusion(df, label, prediction)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("label"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("label"),
                    F.lit(0).cast("bigint").alias("actual"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    per_label = sides.groupBy("label").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    total = cells.agg(F.sum("n")).scalar()
    ratio = lambda top, bottom: F.when(bottom > 0, top / bottom).otherwise(0.0)
    rates = per_label.withColumns(
        {
            "tpr": ratio(F.col("hits"), F.col("actual")),
            "fpr": ratio(F.col("predicted") - F.col("hits"), total - F.col("actual")),
            "precision": ratio(F.col("hits"), F.col("predicted")),
        }
    ).withColumn("recall", F.col("tpr"))
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rates.withColumn("f1", f1).filter(F.col("actual") > 0)


def multiclass_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy, test error, and precision, recall, F1, TPR and FPR weighted by label frequency."""
    per_label = label_metrics(df, label, prediction)
    weighted = lambda c: F.sum(F.col(c) * F.col("actual")) / F.sum("actual")
    accuracy = F.sum("hits") / F.sum("actual")
    return per_label.agg(
        F.sum("actual").alias("n"),
        accuracy.alias("accuracy"),
        (1.0 - accuracy).alias("test_error"),
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1", "tpr", "fpr")],
    )


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mean squared error, its root, mean absolute error, r2."""
    gap = F.col(label) - F.col(prediction)
    sums = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(gap * gap).alias("mse"),
        F.avg(F.abs(gap)).alias("mae"),
        F.var_pop(label).alias("_var"),
    )
    return sums.select(
        "n", "mse", F.sqrt("mse").alias("rmse"), "mae", (1.0 - F.col("mse") / F.col("_var")).alias("r2")
    )


def threshold_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, best first: counts at that threshold, rates, precision, F1.

    Rows are reduced to one per score first; cumulative counts then run over ranges of scores.
    """
    positive = F.when(F.col(label) == 1, 1).otherwise(0)
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(positive).cast("bigint").alias("pos"), F.sum(1 - positive).cast("bigint").alias("neg")
    )
    table = running_totals(per_score, "threshold", ["pos", "neg"], ascending=False)
    positives, negatives = table.agg(F.sum("pos")).scalar(), table.agg(F.sum("neg")).scalar()
    tp, fp = F.col("pos_upto"), F.col("neg_upto")
    return table.select(
        "threshold",
        tp.alias("tp"),
        fp.alias("fp"),
        F.try_divide(tp, positives).alias("tpr"),
        F.try_divide(fp, negatives).alias("fpr"),
        (tp / (tp + fp)).alias("precision"),
        (2 * tp / (tp + fp + positives)).alias("f1"),
    )


def area_under_roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row with the exact area under the ROC curve (ties counted half); null with one class only."""
    positive = F.when(F.col(label) == 1, 1).otherwise(0)
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(positive).cast("bigint").alias("pos"), F.sum(1 - positive).cast("bigint").alias("neg")
    )
    table = running_totals(per_score, "score", ["pos"], ascending=False)
    wins = F.sum(F.col("neg").cast("double") * (F.col("pos_before") + F.col("pos") / 2))
    return table.agg(
        F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("area_under_roc")
    )


def best_threshold(df: DataFrame, score: str, label: str) -> DataFrame:
    """The threshold with the highest F1; the larger one on ties."""
    table = threshold_table(df, score, label)
    return table.agg(F.max(F.struct("f1", "threshold")).alias("b")).select("b.threshold", "b.f1")


def silhouette(df: DataFrame, features: str, cluster: str) -> float:
    """Mean silhouette under squared Euclidean distance; linear in the rows."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(df)
