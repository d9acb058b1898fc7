"""Exact ranking metrics over scored rows.

Every metric reads one reduced table, a row per (group, distinct score) with its positives
and row count. A score shared by many rows therefore costs one row, and ties are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import ratio
from riskspark.operators.ordered import running_totals

Threshold = float | Column


def _col(value: Threshold) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def confusion_columns(label: Column, score: Column, threshold: Threshold) -> dict[str, Column]:
    """Aggregates tp, fp, fn, tn; a score equal to the threshold is an alert."""
    alert = score >= _col(threshold)
    yes, no = label == 1, label == 0
    return {
        "tp": F.count_if(alert & yes),
        "fp": F.count_if(alert & no),
        "fn": F.count_if(~alert & yes),
        "tn": F.count_if(~alert & no),
    }


def confusion(
    df: DataFrame, label: str, score: str, threshold: Threshold, by: Sequence[str] = ()
) -> DataFrame:
    counts = confusion_columns(F.col(label), F.col(score), threshold)
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in counts.items()])


def with_rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall, accuracy; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        }
    )


def score_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, pos, n) per distinct score of rows with a label and a score."""
    value = F.col(score).cast("double")
    kept = df.where(F.col(label).isNotNull() & value.isNotNull() & ~F.isnan(value))
    return kept.groupBy(*by, value.alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count(F.lit(1)).alias("n")
    )


def curve(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Running counts from the highest score down."""
    return running_totals(points, "threshold", ["pos", "n"], by, descending=True)


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, tp, fp, precision, recall) per distinct score."""
    tp, alerts = F.col("run_pos"), F.col("run_n")
    return curve(score_points(df, label, score, by), by).select(
        *by,
        "threshold",
        tp.alias("tp"),
        (alerts - tp).alias("fp"),
        ratio(tp, alerts).alias("precision"),
        ratio(tp, F.col("all_pos")).alias("recall"),
    )


def _average_precision() -> Column:
    step = F.col("pos") * F.col("run_pos") / F.col("run_n")
    return ratio(F.sum(step), F.max("all_pos")).alias("pr_auc")


def _roc_auc() -> Column:
    """Share of (positive, negative) pairs ranked right, ties half; NULL without both classes."""
    negatives = F.col("n") - F.col("pos")
    pairs = F.sum(negatives * (F.col("run_pos") - F.col("pos") / 2))
    pos, rows = F.max("all_pos"), F.max("all_n")
    return F.try_divide(pairs, (pos * (rows - pos)).cast("double")).alias("roc_auc")


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum of precision times the gain in recall, stepwise, one step per distinct score."""
    return curve(score_points(df, label, score, by), by).groupBy(*by).agg(_average_precision())


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return curve(score_points(df, label, score, by), by).groupBy(*by).agg(_roc_auc())


def choose_threshold(
    df: DataFrame,
    label: str,
    score: str,
    min_recall: float = 0.60,
    by: Sequence[str] = (),
    default: float = 0.5,
) -> DataFrame:
    """Highest-precision threshold among 0, 1 and every score that keeps the wanted recall.

    Equal precision goes to the larger threshold; ``default`` where none qualifies.
    """
    points = score_points(df, label, score, by)
    per_score = curve(points, by).select(
        *by, "threshold", F.col("run_pos").alias("tp"), F.col("run_n").alias("alerts"), "all_pos"
    )
    ends = [F.lit(0.0), F.lit(1.0)]
    sentinels = points.groupBy(*by).agg(
        F.array(
            *[
                F.struct(
                    end.alias("threshold"),
                    F.coalesce(F.sum(F.when(F.col("threshold") >= end, F.col("pos"))), F.lit(0))
                    .alias("tp"),
                    F.coalesce(F.sum(F.when(F.col("threshold") >= end, F.col("n"))), F.lit(0))
                    .alias("alerts"),
                    F.sum("pos").alias("all_pos"),
                )
                for end in ends
            ]
        ).alias("ends")
    )
    candidates = per_score.unionByName(sentinels.select(*by, F.inline("ends")))
    precision = ratio(F.col("tp"), F.col("alerts"))
    qualifies = ratio(F.col("tp"), F.col("all_pos")) >= F.lit(float(min_recall))
    best = F.max(F.when(qualifies, F.struct(precision.alias("p"), F.col("threshold").alias("t"))))
    return candidates.groupBy(*by).agg(
        F.coalesce(best["t"], F.lit(float(default))).alias("threshold")
    )


def classification_metrics(
    df: DataFrame, label: str, score: str, threshold: Threshold, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., pr_auc, recall, precision, threshold) from one curve."""
    limit = _col(threshold)
    above = F.col("threshold") >= limit
    tp, alerts = F.sum(F.when(above, F.col("pos"))), F.sum(F.when(above, F.col("n")))
    return curve(score_points(df, label, score, by), by).groupBy(*by).agg(
        _average_precision(),
        ratio(tp, F.max("all_pos")).alias("recall"),
        ratio(tp, alerts).alias("precision"),
        F.max(limit).alias("threshold"),
    )


METRICS = ("pr_auc", "recall", "precision", "threshold")


def metrics_by_split(
    df: DataFrame,
    label: str,
    score: str,
    threshold: Threshold,
    by: Sequence[str] = (),
    names: Sequence[str] = ("val", "test"),
    split: str = "split",
) -> DataFrame:
    """One row per group with each metric of each part as ``<part>_<metric>``."""
    kept = df.where(F.col(split).isin(list(names)))
    rows = classification_metrics(kept, label, score, threshold, [*by, split])
    return rows.groupBy(*by).agg(
        *[
            F.max(F.when(F.col(split) == name, F.col(m))).alias(f"{name}_{m}")
            for name in names
            for m in METRICS
        ]
    )


def positive_rate_column(score: Column, threshold: float) -> Column:
    """Aggregate: share of scored rows at or above the threshold, NULL without scores."""
    value = score.try_cast("double")
    return F.avg(
        F.when(value.isNotNull() & ~F.isnan(value), (value >= threshold).cast("double"))
    )


def positive_rate(df: DataFrame, score: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    rate = positive_rate_column(F.col(score), threshold)
    return df.groupBy(*by).agg(rate.alias("positive_rate"))


def outreach_cost(
    df: DataFrame, label: str, score: str, threshold: Threshold, by: Sequence[str] = ()
) -> DataFrame:
    """Alerts per true positive, share of rows alerted, lift over the base rate."""
    counts = confusion(df, label, score, threshold, by)
    tp, alerts = F.col("tp"), F.col("tp") + F.col("fp")
    rows = alerts + F.col("fn") + F.col("tn")
    base = F.try_divide((tp + F.col("fn")).cast("double"), rows.cast("double"))
    return counts.select(
        *by,
        alerts.alias("alerts"),
        F.try_divide(alerts.cast("double"), tp.cast("double")).alias("alerts_per_hit"),
        F.try_divide(alerts.cast("double"), rows.cast("double")).alias("share_alerted"),
        F.try_divide(F.try_divide(tp.cast("double"), alerts.cast("double")), base).alias("lift"),
    )


def compare_at_budget(
    df: DataFrame, label: str, score: str, event: str, budget: int, by: str = "experiment"
) -> DataFrame:
    """(by, alerts, hits, precision, recall) when each group may alert ``budget`` rows.

    Rows rank by score, equal scores by event id. Scores above the cut count as a whole; only
    the rows that share the cut score are ranked by id.
    """
    ranked = curve(score_points(df, label, score, [by]), [by])
    above = F.col("run_n") <= budget
    cut = ranked.groupBy(by).agg(
        F.max("all_pos").alias("all_pos"),
        F.coalesce(F.max(F.when(above, F.col("run_n"))), F.lit(0)).alias("taken"),
        F.coalesce(F.max(F.when(above, F.col("run_pos"))), F.lit(0)).alias("hits_above"),
        F.max(F.when(~above, F.col("threshold"))).alias("cut"),
    )
    tied = (
        df.where(F.col(label).isNotNull())
        .join(F.broadcast(cut.select(by, "cut")), by)  # one row per experiment
        .where(F.col(score).cast("double") == F.col("cut"))
        .groupBy(by, event)
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count(F.lit(1)).alias("n"))
    )
    ties = running_totals(tied, event, ["n"], [by]).select(by, "pos", "run_n")
    picked = (
        ties.join(cut.select(by, "taken"), by)
        .where(F.col("run_n") <= budget - F.col("taken"))
        .groupBy(by)
        .agg(F.max("run_n").alias("extra"), F.sum("pos").alias("extra_hits"))
    )
    alerts = F.col("taken") + F.coalesce("extra", F.lit(0))
    hits = F.col("hits_above") + F.coalesce("extra_hits", F.lit(0))
    return cut.join(picked, by, "left").select(
        by,
        alerts.alias("alerts"),
        hits.alias("hits"),
        ratio(hits, alerts).alias("precision"),
        ratio(hits, F.col("all_pos")).alias("recall"),
    )


def compare_at_recall(
    df: DataFrame, label: str, score: str, min_recall: float, by: str = "experiment"
) -> DataFrame:
    """(by, alerts, precision): fewest alerts with which each group reaches the recall."""
    reached = curve(score_points(df, label, score, [by]), [by]).where(
        ratio(F.col("run_pos"), F.col("all_pos")) >= min_recall
    )
    return reached.groupBy(by).agg(
        F.min("run_n").alias("alerts"), ratio(F.min("run_pos"), F.min("run_n")).alias("precision")
    )


def experiment_table(
    metrics: DataFrame,
    names: Sequence[str],
    experiment: str = "experiment",
    metric: str = "metric",
    value: str = "value",
) -> DataFrame:
    """Long (experiment, metric, value) rows to one row per experiment, best first metric on top."""
    wide = metrics.groupBy(experiment).pivot(metric, list(names)).agg(F.max(value))
    return wide.orderBy(F.col(names[0]).desc_nulls_last(), experiment)
