"""Scoring rows with a fitted model."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns a classifier adds; the score is kept instead.
_MODEL_OUTPUT = ("rawPrediction", "probability", "prediction")


def with_score(df: DataFrame, model: Model) -> DataFrame:
    """Add ``score``, the probability of the positive class."""
    scored = model.transform(df)
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(*_MODEL_OUTPUT)


def prediction_columns(
    score: Column, threshold: float, version: str, entity: Column
) -> list[Column]:
    """The prediction row. The alert looks at the unrounded score."""
    return [
        entity.cast("double").alias("patient_id"),
        F.round(score, 6).alias("score"),
        (score >= F.lit(float(threshold))).alias("alert"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(version).alias("model_version"),
    ]


def score_batch(
    df: DataFrame,
    model: PipelineModel | Model,
    threshold: float,
    version: str,
    entity: str = "patient_id",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Prediction rows, with the columns of ``keep`` in front."""
    scored = with_score(df, model)
    columns = prediction_columns(F.col("score"), threshold, version, F.col(entity))
    return scored.select(*keep, *columns)


def alert_count(predictions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return predictions.groupBy(*by).agg(F.count_if("alert").alias("n_alerts"))
