"""Clusters of vectors, topics of documents, communities of weighted graphs."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import PowerIterationClustering
from pyspark.sql import Column, DataFrame, functions as F

from loomframe.functions.vectors import euclidean, vector_array
from loomframe.session import ensure_checkpoint_dir


def centre_distances(model, features: str) -> Column:
    """Distance of a row to every cluster centre."""
    x = vector_array(features)
    centres = [F.array(*[F.lit(float(v)) for v in centre]) for centre in model.clusterCenters()]
    return F.array(*[euclidean(x, centre) for centre in centres])


def component_rows(spark, model) -> DataFrame:
    """``(component, weight, mean, covariance)`` of a Gaussian mixture, covariances row by row."""
    rows = []
    for k, (weight, shape) in enumerate(zip(model.weights, model.gaussians)):
        rows.append((k, float(weight), [float(x) for x in shape.mean.toArray()], [float(x) for x in shape.cov.toArray().reshape(-1)]))
    return spark.createDataFrame(rows, "component int, weight double, mean array<double>, covariance array<double>")


def responsibilities(components: DataFrame, features: str) -> Column:
    """The probability of each component for a row, from the rows of :func:`component_rows`.

    Each step is an array that the next one takes as the variable of a lambda function: written out, it would be computed
    again wherever it is named, the logs some ``components ** 2`` times over for each result.
    """
    shapes = []
    for row in components.orderBy("component").collect():
        mean, width = np.array(row["mean"]), len(row["mean"])
        values, axes = np.linalg.eigh(np.array(row["covariance"]).reshape(width, width))
        whitened = axes / np.sqrt(values)
        shapes.append((float(np.log(row["weight"]) - np.log(values).sum() / 2), mean, whitened.T))

    def log(x: Column, level: float, mean: np.ndarray, axes: np.ndarray) -> Column:
        # The squared length of the whitened row, an axis at a time.
        distance = F.lit(0.0)
        for axis in axes:
            weights, shift = F.array(*[F.lit(float(w)) for w in axis]), float(axis @ mean)
            along = F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(-shift), lambda acc, v: acc + v)
            distance = distance + F.pow(along, F.lit(2))
        return F.lit(level) - distance / 2

    logs = F.transform(F.array(vector_array(features)), lambda x: F.array(*[log(x, *shape) for shape in shapes]))
    highest = F.transform(logs, lambda found: F.struct(found.alias("logs"), F.array_max(found).alias("top")))
    parts = F.transform(highest, lambda h: F.transform(h["logs"], lambda value: F.exp(value - h["top"])))
    totals = F.transform(parts, lambda p: F.struct(p.alias("parts"), F.aggregate(p, F.lit(0.0), lambda acc, y: acc + y).alias("sum")))
    return F.get(F.transform(totals, lambda t: F.transform(t["parts"], lambda v: v / t["sum"])), F.lit(0))


def undirected_edges(edges: DataFrame, src: str, dst: str, weight: str) -> DataFrame:
    """One row per unordered pair: both directions and parallel edges added up, loops left out."""
    return (
        edges.filter(F.col(src) != F.col(dst))
        .groupBy(F.least(src, dst).cast("bigint").alias("src"), F.greatest(src, dst).cast("bigint").alias("dst"))
        .agg(F.sum(weight).cast("double").alias("weight"))
    )


def communities(edges: DataFrame, k: int, iterations: int = 10, start: str = "degree") -> DataFrame:
    """``(id, cluster)`` by power iteration on an edge table ``(src, dst, weight)``."""
    ensure_checkpoint_dir(edges.sparkSession)
    stage = PowerIterationClustering(k=k, maxIter=iterations, initMode=start, weightCol="weight")
    return stage.assignClusters(edges)
