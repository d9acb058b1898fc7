"""Joining the prediction log to outcomes that arrive later, as two streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.drift import action_columns
from riskspark.schema import Policy


def feedback_stream(
    predictions: DataFrame,
    outcomes: DataFrame,
    key: str,
    predicted_at: str,
    outcome_at: str,
    max_lag: str | None = None,
    late: str = "1 day",
) -> DataFrame:
    """Predictions with the outcome that became known after them, like the batch form.

    Without ``max_lag`` every outcome is matched, however late, and Spark keeps all rows as
    state. With it outcomes count up to that lag only, and the bound and the watermarks of
    ``late`` let Spark drop rows that can no longer match.
    """
    if max_lag is not None:
        predictions = predictions.withWatermark(predicted_at, late)
        outcomes = outcomes.withWatermark(outcome_at, late)
    p, o = predictions.alias("p"), outcomes.alias("o")
    begin, end = F.col(f"p.{predicted_at}"), F.col(f"o.{outcome_at}")
    match = (F.col(f"p.{key}") == F.col(f"o.{key}")) & (end >= begin)
    if max_lag is not None:
        match = match & (end <= begin + F.expr(f"INTERVAL {max_lag}"))
    extra = [c for c in outcomes.columns if c not in predictions.columns]
    return p.join(o, match).select("p.*", *[F.col(f"o.{c}") for c in extra])


def labels_stream(
    predictions: DataFrame,
    outcomes: DataFrame,
    key: str,
    predicted_at: str,
    outcome_at: str,
    max_lag: str,
    late: str = "1 day",
) -> DataFrame:
    """Every prediction once: with its outcome, or as ``expired`` when none came within ``max_lag``.

    ``label_state`` is ``labeled`` or ``expired``. A prediction expires when the watermark has passed
    its time plus the lag, and is then dropped from the state, as outcomes are that no prediction
    can wait for. A NULL key never finds an outcome, and rows without one do not move the watermark.
    A prediction is repeated for every one of its outcomes.
    """
    p = predictions.withWatermark(predicted_at, late).alias("p")
    o = outcomes.withWatermark(outcome_at, late).alias("o")
    begin, end = F.col(f"p.{predicted_at}"), F.col(f"o.{outcome_at}")
    match = (F.col(f"p.{key}") == F.col(f"o.{key}")) & (end >= begin) & (end <= begin + F.expr(f"INTERVAL {max_lag}"))
    extra = [c for c in outcomes.columns if c not in predictions.columns]
    state = F.when(F.col(f"o.{key}").isNull(), "expired").otherwise("labeled")
    return p.join(o, match, "left").select("p.*", *[F.col(f"o.{c}") for c in extra], state.alias("label_state"))


def label_supply(states: DataFrame, predicted_at: str, length: str, policy: Policy = Policy()) -> DataFrame:
    """(window_start, predictions, labeled, expired, label_state, action) of windows of predictions.

    ``label_state`` is the one that ``action_columns`` asks for: windows without enough labels say
    WAIT_FOR_LABELS, however many predictions they hold.
    """
    labeled = F.count_if(F.col("label_state") == "labeled")
    found = states.groupBy(F.window(predicted_at, length)["start"].alias("window_start")).agg(
        F.count(F.lit(1)).alias("predictions"),
        labeled.alias("labeled"),
        F.count_if(F.col("label_state") == "expired").alias("expired"),
        F.when(labeled >= policy.min_labeled_rows, "enough_labels").otherwise("not_enough_labels").alias("label_state"),
    )
    no = F.lit(False)
    return found.withColumn("action", action_columns(no, no, no, F.col("label_state"))["action"])
