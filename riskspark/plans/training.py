"""The training job: validate, clean, split, build features, fit, evaluate, gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.clean import clean, time_split, with_target
from riskspark.operators.features import FeatureBuilder, FeatureBuilderModel
from riskspark.operators.models import Experiment, run_experiments
from riskspark.operators.prep import fit_preprocessor
from riskspark.operators.scoring import prediction_columns, with_score
from riskspark.operators.validate import check_split, require_valid
from riskspark.schema import TABLE_FIELDS, Split
from riskspark.session import materialize


@dataclass
class Scorer:
    """Everything needed to turn request rows into predictions."""

    features: FeatureBuilderModel
    model: PipelineModel
    threshold: float
    version: str

    def __post_init__(self):
        if not 0.0 <= self.threshold <= 1.0:
            raise ValueError(f"threshold must be in [0, 1], got {self.threshold}")

    def score(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        scored = with_score(self.features.transform(df), self.model)
        columns = prediction_columns(
            F.col("score"), self.threshold, self.version, F.col("patient_id")
        )
        return scored.select(*keep, *columns)

    def save(self, path: str) -> None:
        self.features.save(f"{path}/features")
        self.model.write().overwrite().save(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str, threshold: float, version: str) -> Scorer:
        """Ready for small batches: history is cut to the entities of each batch."""
        features = FeatureBuilderModel.load(spark, f"{path}/features", prune_history=True)
        return Scorer(features, PipelineModel.load(f"{path}/model"), threshold, version)


def prepare(raw: DataFrame, split: Split) -> tuple[DataFrame, FeatureBuilderModel, PipelineModel]:
    """Split rows with features and vectors; both fitted on the train part only.

    History and features are written once: fill values, scaling, categories and every fit read
    the features again, and none of them should repeat the history join.
    """
    rows = with_target(time_split(clean(raw), split))
    train = rows.where(F.col("split") == split.names[0])
    builder = FeatureBuilder().fit(train)
    builder.history = materialize(builder.history, "history")
    featured = materialize(builder.transform(rows), "features")
    preprocessor = fit_preprocessor(featured.where(F.col("split") == split.names[0]))
    return preprocessor.transform(featured), builder, preprocessor


def train_and_evaluate(
    raw: DataFrame, split: Split, experiments: list[Experiment], check: bool = True
) -> tuple[DataFrame, dict[str, Model], FeatureBuilderModel, PipelineModel]:
    """Long metric rows and the fitted models. Bad data or a one-class part stops the job."""
    if check:
        wanted = {f.name for f in TABLE_FIELDS}
        require_valid(
            raw.select([c for c in raw.columns if c in wanted]), TABLE_FIELDS, ["appointment_id"]
        )
    prepared, builder, preprocessor = prepare(raw, split)
    parts = check_split(prepared, "target", split.names).where("NOT ok").collect()
    if parts:
        raise ValueError(f"parts without rows or without both classes: {[p['split'] for p in parts]}")
    narrow = prepared.select("appointment_id", "features", "target", "split")
    metrics, models = run_experiments(narrow, experiments)
    return metrics, models, builder, preprocessor


def scorer(
    builder: FeatureBuilderModel,
    preprocessor: PipelineModel,
    model: Model,
    threshold: float,
    version: str,
) -> Scorer:
    pipeline = PipelineModel([*preprocessor.stages, model])
    return Scorer(builder, pipeline, threshold, version)
