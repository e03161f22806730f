"""Saving and loading of estimators and fitted models."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.recommendation import ALSModel


def save(stage, path: str) -> str:
    """Write a pipeline, a fitted pipeline or any single model, replacing what is there."""
    stage.write().overwrite().save(path)
    return path


def load_unfitted(path: str) -> Pipeline:
    return Pipeline.load(path)


def load_fitted(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_recommender(path: str) -> ALSModel:
    return ALSModel.load(path)
