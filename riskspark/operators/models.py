"""Fitting class-weighted classifiers and what belongs to a fitted model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.operators.metrics import METRICS, choose_threshold, metrics_by_split
from riskspark.operators.prep import balanced_weight, feature_names
from riskspark.operators.scoring import with_score
from riskspark.session import materialize


def fit_logistic(train: DataFrame, label: str = "target", c: float = 1.0, max_iter: int = 1000):
    """L2 logistic regression with balanced classes.

    The usual objective is |w|^2 / 2 + c * (weighted loss); Spark divides the loss by the total
    weight, so its strength is 1 / (c * total weight). Balanced weights add up to the row count.
    """
    weighted = balanced_weight(train, label)
    total = weighted.agg(F.sum("weight")).first()[0]
    return LogisticRegression(
        labelCol=label,
        weightCol="weight",
        maxIter=max_iter,
        regParam=1.0 / (c * total),
        elasticNetParam=0.0,
        standardization=False,
        tol=1e-6,
    ).fit(weighted)


def fit_boosted(train: DataFrame, label: str = "target", trees: int = 200, seed: int = 42):
    """Boosted trees with balanced classes; ranks like other boosters, scores differ."""
    return GBTClassifier(
        labelCol=label, weightCol="weight", maxIter=trees, maxDepth=5, stepSize=0.1, seed=seed
    ).fit(balanced_weight(train, label))


def fit_boosted_tuned(train: DataFrame, label: str = "target", trees: int = 400, seed: int = 42):
    """Slower learning, deeper trees, at least 30 rows per leaf, 80 % of the columns per split."""
    return GBTClassifier(
        labelCol=label,
        weightCol="weight",
        maxIter=trees,
        maxDepth=8,
        stepSize=0.03,
        minInstancesPerNode=30,
        featureSubsetStrategy="0.8",
        seed=seed,
    ).fit(balanced_weight(train, label))


@dataclass(frozen=True)
class Experiment:
    """A named fit; ``threshold`` None means: choose it on the validation part."""

    name: str
    fit: object
    threshold: float | None = 0.5


def default_experiments(trees: int = 200, tuned_trees: int = 400) -> list[Experiment]:
    return [
        Experiment("logistic_balanced", fit_logistic),
        Experiment("boosted_balanced", lambda df: fit_boosted(df, trees=trees)),
        Experiment("boosted_tuned", lambda df: fit_boosted_tuned(df, trees=tuned_trees), None),
    ]


def run_experiments(
    prepared: DataFrame,
    experiments: Sequence[Experiment],
    label: str = "target",
    min_recall: float = 0.60,
) -> tuple[DataFrame, dict[str, Model]]:
    """Fit each experiment on the train part; long (experiment, metric, value) and the models.

    ``prepared`` has features, label and split. It is kept for the fits, as every boosting
    round reads it again.
    """
    kept = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train = kept.where(F.col("split") == "train")
        models, rows = {}, []
        for experiment in experiments:
            model = models[experiment.name] = experiment.fit(train)
            scored = with_score(kept.where(F.col("split") != "train"), model).select(
                label, "score", "split"
            )
            threshold = experiment.threshold
            if threshold is None:
                val = scored.where(F.col("split") == "val")
                threshold = choose_threshold(val, label, "score", min_recall).first()["threshold"]
            wide = metrics_by_split(scored, label, "score", threshold)
            names = [f"{part}_{m}" for part in ("val", "test") for m in METRICS]
            rows.append(wide.select(F.lit(experiment.name).alias("experiment"), *names))
        all_rows = rows[0]
        for row in rows[1:]:
            all_rows = all_rows.unionByName(row)
        # A few metric rows, written while the kept table is there.
        return materialize(all_rows.unpivot("experiment", names, "metric", "value"), "metrics"), models
    finally:
        kept.unpersist()


def linear_importance(df: DataFrame, model) -> DataFrame:
    """(feature, deviation, importance): mean |x - mean| of all rows, times |coefficient|, largest first."""
    names = feature_names(df)
    cells = df.select(F.posexplode(vector_to_array("features")).alias("i", "x"))
    means = cells.groupBy("i").agg(F.avg("x").alias("mean"))
    slots = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(float(w)).alias("w"))
                      for n, w in zip(names, model.coefficients.toArray())])
    return (
        cells.join(F.broadcast(means), "i")  # one row per slot of the vector
        .groupBy("i")
        .agg(F.avg(F.abs(F.col("x") - F.col("mean"))).alias("deviation"))
        .withColumn("slot", F.get(slots, F.col("i")))
        .select(
            F.col("slot.n").alias("feature"),
            "deviation",
            (F.abs("slot.w") * F.col("deviation")).alias("importance"),
        )
        .orderBy(F.desc("importance"), "feature")
    )


def source_column(slot: str) -> str:
    """The column that a slot of the vector was made from."""
    return slot.split("_filled_hot_")[0].removesuffix("_scaled")


def permutation_importance(df: DataFrame, model, key: str, seed: int = 42, bucket: int = 1000) -> DataFrame:
    """(feature, importance): mean change of the score when a column comes from another row.

    All rows take part; keys are unique. A row's donor is the next one by seeded hash among about ``bucket``
    others; all slots of a source column change together, in one scoring job.
    """
    slots: dict[str, list[int]] = {}
    for i, name in enumerate(feature_names(df)):
        slots.setdefault(source_column(name), []).append(i)
    buckets = max(1, -(-df.count() // bucket))
    rows = df.select(key, vector_to_array("features").alias("x"))
    order = Window.partitionBy(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets))).orderBy(
        F.xxhash64(F.col(key), F.lit(seed + 1)), key
    )
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lead("x").over(order), F.first("x").over(whole))
    numbers = F.sequence(F.lit(-1), F.lit(len(slots) - 1))
    spread = rows.select(key, "x", other.alias("y")).select(key, "x", "y", F.explode(numbers).alias("i"))
    moved = F.coalesce(
        F.get(F.array(*[F.array(*[F.lit(j) for j in own]) for own in slots.values()]), F.col("i")),
        F.array().cast("array<int>"),
    )
    changed = F.transform(
        F.arrays_zip("x", "y"),
        lambda cell, j: F.when(F.array_contains(F.col("moved"), j), cell["y"]).otherwise(cell["x"]),
    )
    scored = with_score(
        spread.withColumn("moved", moved).select(key, "i", array_to_vector(changed).alias("features")), model
    )
    # A row's scores meet by its key, so that every copy is scored once.
    copy = F.when(F.col("i") >= 0, F.struct("i", "score"))
    scores = scored.groupBy(key).agg(F.max(F.when(F.col("i") < 0, F.col("score"))).alias("base"), F.collect_list(copy).alias("moved"))
    label = F.get(F.array(*[F.lit(n) for n in slots]), F.col("i"))
    return (
        scores.select("base", F.inline("moved"))
        .groupBy(label.alias("feature"))
        .agg(F.avg(F.abs(F.col("score") - F.col("base"))).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def save_load_check(model: PipelineModel, df: DataFrame, path: str) -> DataFrame:
    """(rows, max_difference) of scores before saving and after loading, in one pass."""
    model.write().overwrite().save(path)
    reloaded = PipelineModel.load(path)
    first = with_score(df, model).withColumnRenamed("score", "before").select(*df.columns, "before")
    both = with_score(first, reloaded)
    gap = F.abs(F.col("score") - F.col("before"))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.max(gap).alias("max_difference"))


def artifact_size_mb(spark: SparkSession, path: str) -> DataFrame:
    """(size_mb): bytes of all files below a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg((F.sum("length") / 1e6).alias("size_mb"))
