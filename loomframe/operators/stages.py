"""Applying transformers and estimators: one call for both, with parameters that override the setters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession

from loomframe.session import ensure_checkpoint_dir


def fitted(stage: Estimator | Transformer, df: DataFrame, params: Mapping | None = None) -> Transformer:
    """The stage fitted on ``df``; a transformer is returned as it is. ``params`` beat the stage's setters."""
    ensure_checkpoint_dir(df.sparkSession)
    if isinstance(stage, Estimator):
        return stage.fit(df, dict(params)) if params else stage.fit(df)
    return stage.copy(dict(params)) if params else stage


def apply(stage: Estimator | Transformer, df: DataFrame, params: Mapping | None = None) -> DataFrame:
    """Fit where needed, then transform the same frame."""
    return fitted(stage, df, params).transform(df)


def chain(*stages: Estimator | Transformer) -> Pipeline:
    """A stage list as one estimator."""
    return Pipeline(stages=list(stages))


def stage_of(model: PipelineModel, kind: type) -> Model:
    """The first fitted stage of a type."""
    for stage in model.stages:
        if isinstance(stage, kind):
            return stage
    raise LookupError(f"no {kind.__name__} among the stages")


def check_grid(estimator: Estimator, grid: Sequence[Mapping]) -> None:
    """Fail when a grid sets a parameter no stage owns: such points would repeat each other."""
    owners = {estimator.uid}
    pending = list(estimator.getStages()) if isinstance(estimator, Pipeline) else []
    while pending:
        stage = pending.pop()
        owners.add(stage.uid)
        if isinstance(stage, Pipeline):
            pending.extend(stage.getStages())
    stray = {param.name for point in grid for param in point if param.parent not in owners}
    if stray:
        raise ValueError(f"grid parameters of stages outside the estimator: {sorted(stray)}")


def vocabulary_frame(spark: SparkSession, vocabulary: Sequence[str]) -> DataFrame:
    """``(pos, term)`` of a fitted vocabulary, whose size the estimator bounds."""
    return spark.createDataFrame(list(enumerate(vocabulary)), "pos int, term string")
