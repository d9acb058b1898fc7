"""Writing splits, drift sets, reports, metrics and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.drift import shift_concept, shift_covariates


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder per part, so that reading a part lists only its files."""
    df.write.partitionBy(split).parquet(path)


def drift_sets(df: DataFrame, split: str = "split") -> DataFrame:
    """The train part as reference, and the test part with shifted inputs and shifted outcomes."""
    train = df.where(F.col(split) == "train").drop(split)
    test = df.where(F.col(split) == "test").drop(split)
    return (
        train.withColumn("set", F.lit("reference"))
        .unionByName(shift_covariates(test).withColumn("set", F.lit("data_drift")))
        .unionByName(shift_concept(test).withColumn("set", F.lit("concept_drift")))
    )


def write_drift_sets(df: DataFrame, path: str, split: str = "split") -> None:
    drift_sets(df, split).write.partitionBy("set").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report as JSON, NULL fields included."""
    report.write.option("ignoreNullFields", "false").mode("append").json(path)


def report_to_metrics(report: DataFrame) -> DataFrame:
    """Report rows to (metric, label, value): flags as 0/1, NULL left out."""

    def number(column):
        return F.when(column, 1.0).otherwise(0.0)

    performance = report.schema["performance"].dataType.typeName() == "struct"
    values = {
        "report_available": F.lit(1.0),
        "data_drift_share": F.col("drift_share"),
        "concept_drift_suspected": number(F.col("concept_drift")),
        "performance_alert": number(F.col("performance_alert")),
        "retrain_recommended": number(F.col("action") == "RETRAIN"),
        "prediction_positive_rate": F.col("prediction_positive_rate"),
        "prediction_drift_alert": number(F.col("prediction_drift_alert")),
        "effect_delta": F.col("effect_delta"),
        "last_run_timestamp_seconds": F.unix_micros("generated_at") / 1e6,
    }
    if performance:
        for name in ("labeled_rows", "roc_auc", "precision", "recall", "accuracy"):
            values[name] = F.col(f"performance.{name}")
    limits = {
        "drift_share_threshold": "drift_share_threshold",
        "min_roc_auc_threshold": "min_roc_auc",
        "effect_delta_threshold": "effect_delta_threshold",
        "p95_latency_threshold_seconds": "p95_latency_seconds",
        "error_rate_threshold": "error_rate_threshold",
        "min_labeled_rows_threshold": "min_labeled_rows",
    }
    for name, key in limits.items():
        values[name] = F.try_element_at("policy", F.lit(key))
    plain = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.lit(None).cast("string").alias("label"),
                value.cast("double").alias("value"),
            )
            for name, value in values.items()
        ]
    )
    by_feature = F.transform(
        F.map_entries("feature_psi"),
        lambda e: F.struct(
            F.lit("feature_psi").alias("metric"), e["key"].alias("label"), e["value"].alias("value")
        ),
    )
    rows = report.select(F.inline(F.concat(plain, by_feature)))
    return rows.where(F.col("value").isNotNull())


def metric_lines(metrics: DataFrame, label: str = "feature") -> DataFrame:
    """(metric, label, value) rows as text metric lines."""
    escaped = F.regexp_replace(F.regexp_replace("label", r"\\", r"\\\\"), '"', r'\\"')
    tag = F.when(
        F.col("label").isNotNull(), F.concat(F.lit("{" + label + '="'), escaped, F.lit('"}'))
    ).otherwise("")
    return metrics.select(F.concat("metric", tag, F.lit(" "), F.col("value").cast("string")).alias("value"))
