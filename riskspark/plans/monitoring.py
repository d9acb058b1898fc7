"""The monitoring job: reference, current and optional feedback to one nested report row."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import normalize_label, resolve_column
from riskspark.operators.drift import (
    action_columns,
    concept_drift,
    delayed_performance,
    drift_summary,
    effect_column,
    feature_psi,
    prediction_drift_columns,
)
from riskspark.operators.features import monitoring_features
from riskspark.operators.metrics import positive_rate_column
from riskspark.schema import Policy

# Accepted spellings, in order of preference.
LABEL_NAMES = ["No-show", "No_show", "NoShow", "no_show"]
SCORE_NAMES = ["noshow_score", "no_show_score", "y_proba", "score"]
GROUP_NAMES = ["SMS_received", "sms_received"]


def with_label(df: DataFrame, name: str = "_label") -> DataFrame:
    """Add the normalised label of whichever label column the table has, NULL without one."""
    found = resolve_column(df, LABEL_NAMES)
    if found is None:
        return df.withColumn(name, F.lit(None).cast("int"))
    numeric = isinstance(df.schema[found].dataType, T.NumericType)
    return df.withColumn(name, normalize_label(F.col(f"`{found}`"), numeric))


def with_score(df: DataFrame, name: str = "_score_in") -> DataFrame:
    found = resolve_column(df, SCORE_NAMES)
    column = F.lit(None) if found is None else F.col(f"`{found}`")
    return df.withColumn(name, column.try_cast("double"))


def with_group(df: DataFrame, name: str = "_group") -> DataFrame:
    found = resolve_column(df, GROUP_NAMES)
    column = F.lit(None) if found is None else F.col(f"`{found}`")
    return df.withColumn(name, column.try_cast("double"))


def side_facts(df: DataFrame, policy: Policy) -> DataFrame:
    """(n, rate, effect) of one side from one scan: rows, positive rate, group effect."""
    rows = with_group(with_score(with_label(df)))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        positive_rate_column(F.col("_score_in"), policy.score_threshold).alias("rate"),
        effect_column(F.col("_group"), F.col("_label")).alias("effect"),
    )


def feedback_row(feedback: DataFrame, baseline_effect: Column, policy: Policy) -> DataFrame:
    """Performance and concept drift of the feedback rows, one row."""
    if resolve_column(feedback, LABEL_NAMES) is None or resolve_column(feedback, SCORE_NAMES) is None:
        raise ValueError("feedback needs a label column and a score column")
    rows = with_group(with_score(with_label(feedback)))
    performance = delayed_performance(rows, "_label", "_score_in", "_group", policy)
    return concept_drift(performance, baseline_effect, policy)


def monitoring_report(
    reference: DataFrame,
    current: DataFrame,
    feedback: DataFrame | None = None,
    policy: Policy = Policy(),
    generated_at: str | None = None,
) -> DataFrame:
    """One nested row; every part is a scalar subquery over its own aggregate.

    A side of fewer than two rows is an error when the report is read.
    """
    ref, cur = monitoring_features(reference), monitoring_features(current)
    common = [c for c in ref.columns if c in cur.columns]
    drift = drift_summary(feature_psi(ref.select(common), cur.select(common)), policy)
    facts = side_facts(reference, policy)

    def as_struct(df: DataFrame, name: str) -> Column:
        return df.select(F.struct(*df.columns)).scalar().alias(name)

    parts = [
        as_struct(facts, "r"),
        as_struct(side_facts(current, policy), "c"),
        as_struct(drift, "d"),
    ]
    if feedback is not None:
        effect = facts.select("effect").scalar()
        parts.append(as_struct(feedback_row(feedback, effect, policy), "f"))
    row = reference.sparkSession.range(1).select(*parts)
    moved = prediction_drift_columns(F.col("r.rate"), F.col("c.rate"), policy)
    if feedback is None:
        concept, state = F.lit(False), F.lit("waiting_for_labeled_feedback")
        performance, delta, alert = F.lit(None), F.lit(None).cast("double"), F.lit(False)
    else:
        concept, alert = F.col("f.concept_drift"), F.col("f.performance_alert")
        delta, enough = F.col("f.effect_delta"), F.col("f.enough_labeled_rows")
        state = F.when(enough, "enough_labels").otherwise("not_enough_labels")
        rates = F.filter(
            F.array(
                F.struct(F.lit("0").alias("g"), F.col("f.rate0").alias("r")),
                F.struct(F.lit("1").alias("g"), F.col("f.rate1").alias("r")),
            ),
            lambda e: e["r"].isNotNull(),
        )
        performance = F.struct(
            *[
                F.col(f"f.{c}").alias(c)
                for c in (
                    "labeled_rows", "enough_labeled_rows", "roc_auc", "precision", "recall",
                    "accuracy", "positive_prediction_rate",
                )
            ],
            F.map_from_entries(rates).alias("group_rate"),
        )
    limits = F.create_map(
        *[
            item
            for name, value in asdict(policy).items()
            for item in (F.lit(name), F.lit(None if value is None else float(value)).cast("double"))
        ]
    )
    stamp = F.lit(generated_at).cast("timestamp") if generated_at else F.current_timestamp()
    decided = action_columns(concept, F.col("d.alert"), moved["alert"], state)
    return row.select(
        stamp.alias("generated_at"),
        two_or_more(F.col("r.n"), "reference").alias("reference_rows"),
        two_or_more(F.col("c.n"), "current").alias("current_rows"),
        F.array(*[F.lit(c) for c in common]).alias("features_checked"),
        F.col("d.by_feature").alias("feature_psi"),
        F.col("d.drifted").alias("drifted_features"),
        F.col("d.drift_share").alias("drift_share"),
        F.col("d.alert").alias("data_drift_alert"),
        F.col("c.rate").alias("prediction_positive_rate"),
        moved["delta"].alias("prediction_positive_rate_delta"),
        moved["alert"].alias("prediction_drift_alert"),
        state.alias("label_state"),
        performance.alias("performance"),
        delta.alias("effect_delta"),
        concept.alias("concept_drift"),
        alert.alias("performance_alert"),
        *[c.alias(name) for name, c in decided.items()],
        limits.alias("policy"),
    )


def two_or_more(rows: Column, name: str) -> Column:
    """The row count, or an error where it is too small for a comparison."""
    return F.when(rows >= 2, rows).otherwise(F.raise_error(F.lit(f"{name} needs at least two rows")))
