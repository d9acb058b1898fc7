"""Input, prediction and concept drift.

All column comparisons start from one table: a row per (feature, distinct value) with the
number of reference and current rows. Both sides are reduced to it in one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import MISSING
from riskspark.operators.features import numeric_features
from riskspark.operators.metrics import (
    confusion_columns,
    curve,
    positive_rate,
    score_points,
    with_rates,
)
from riskspark.operators.metrics import _roc_auc as roc_auc_column
from riskspark.operators.ordered import linear_quantiles, running_totals
from riskspark.operators.skew import lookup_join
from riskspark.schema import Policy

EPSILON = 1e-6  # fixed value: floor of a bin's share

SIDES = ["ref", "cur"]


def literal_rows(df: DataFrame, values: Sequence[str], name: str) -> DataFrame:
    """A one-column table of the given words, in the session of ``df``."""
    words = F.array(*[F.lit(v) for v in values])
    return df.sparkSession.range(1).select(F.explode(words).alias(name))


def feature_counts(
    ref: DataFrame, cur: DataFrame, numeric: Sequence[str] = (), text: Sequence[str] = ()
) -> DataFrame:
    """(feature, value, category, ref, cur): rows per distinct cell value on each side.

    Numeric columns fill ``value`` and leave out NULL and NaN; text columns fill ``category``
    and count NULL as its own category.
    """
    no_value, no_category = F.lit(None).cast("double"), F.lit(None).cast("string")

    def cells(df: DataFrame, side: str) -> DataFrame:
        columns = [
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"`{c}`").try_cast("double").alias("value"),
                no_category.alias("category"),
            )
            for c in numeric
        ] + [
            F.struct(
                F.lit(c).alias("feature"),
                no_value.alias("value"),
                F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING)).alias("category"),
            )
            for c in text
        ]
        return df.select(F.inline(F.array(*columns)), F.lit(side).alias("side"))

    both = cells(ref, "ref").unionByName(cells(cur, "cur"))
    known = both.where(
        F.col("category").isNotNull() | (F.col("value").isNotNull() & ~F.isnan("value"))
    )
    return known.groupBy("feature", "value", "category").agg(
        *[F.count_if(F.col("side") == s).alias(s) for s in SIDES]
    )


def reference_edges(counts: DataFrame, bins: int = 10) -> DataFrame:
    """(feature, inner): distinct inner bin edges from exact reference quantiles.

    The outer edges are open. A feature with fewer than two distinct edges has no inner edge.
    """
    ref = counts.where("ref > 0 AND category IS NULL").select("feature", "value", "ref")
    totals = running_totals(ref, "value", ["ref"], ["feature"])
    probs = [min(i * (1.0 / bins), 1.0) for i in range(bins + 1)]
    found = linear_quantiles(totals, "value", probs, ["feature"], "ref")
    names = ", ".join(f"q{i}" for i in range(bins + 1))
    edges = found.selectExpr("feature", f"array_sort(array_distinct(array({names}))) AS e")
    return edges.selectExpr("feature", "filter(e, (_, i) -> i > 0 AND i < size(e) - 1) AS inner")


def psi_of_counts(counts: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, psi). Numeric bins are closed on the left; categories are their own bins.

    A numeric column without values on one side gets 0.
    """
    # One row per numeric column, with fewer than ``bins`` numbers each: bounded by the schema.
    edges = F.broadcast(reference_edges(counts, bins))
    number = F.size(F.filter("inner", lambda e: e <= F.col("value"))).cast("string")
    binned = (
        counts.join(edges, "feature", "left")
        .groupBy(
            "feature",
            F.col("category").isNull().alias("numeric"),
            F.coalesce("category", number).alias("bin"),
        )
        .agg(*[F.sum(s).alias(s) for s in SIDES])
    )
    found = psi_of_bins(binned)
    return literal_rows(counts, columns, "feature").join(found, "feature", "left").select(
        "feature", F.coalesce("psi", F.lit(0.0)).alias("psi")
    )


def psi_of_bins(binned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, psi) from (by..., feature, numeric, bin, ref, cur).

    A numeric column without values on one side has no row.
    """
    keys = [*by, "feature"]
    totals = binned.groupBy(*keys, "numeric").agg(*[F.sum(s).alias(f"all_{s}") for s in SIDES])
    totals = totals.where("NOT numeric OR (all_ref > 0 AND all_cur > 0)").drop("numeric")
    expected, actual = [
        F.greatest(F.col(s) / F.greatest(F.col(f"all_{s}"), F.lit(1)), F.lit(EPSILON))
        for s in SIDES
    ]
    # One row per column of the table, and per group where there are any.
    found = binned.join(totals if by else F.broadcast(totals), keys)
    return found.groupBy(*keys).agg(F.sum((actual - expected) * F.log(actual / expected)).alias("psi"))


def psi_numeric(
    ref: DataFrame, cur: DataFrame, columns: Sequence[str], bins: int = 10
) -> DataFrame:
    """(feature, psi) with bins at exact, interpolated reference quantiles."""
    return psi_of_counts(feature_counts(ref, cur, numeric=columns), columns, bins)


def psi_categorical(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, psi) over the union of categories."""
    return psi_of_counts(feature_counts(ref, cur, text=columns), columns)


# Monitored columns with few whole values.
DISCRETE = [
    "scholarship",
    "hipertension",
    "hypertension",
    "diabetes",
    "alcoholism",
    "handcap",
    "handicap",
    "sms_received",
]


def feature_psi(
    ref: DataFrame, cur: DataFrame, bins: int = 10, discrete_as_category: bool = False
) -> DataFrame:
    """(feature, psi), 6 decimals, for every monitored column both sides have.

    The reference side decides which columns are numeric. With quantile bins a 0/1 column has
    a single bin and a PSI of 0; ``discrete_as_category`` compares columns of flags by value.
    """
    common = [c for c in ref.columns if c in cur.columns]
    if not common:
        raise ValueError("reference and current have no common columns")
    numeric = numeric_features(ref.select(common))
    if discrete_as_category:
        numeric = [c for c in numeric if c not in DISCRETE]
    text = [c for c in common if c not in numeric]
    counts = feature_counts(ref, cur, numeric, text)
    return psi_of_counts(counts, common, bins).withColumn("psi", F.round("psi", 6))


def drift_summary(psi: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """(features, by_feature, drifted, drift_share, alert) from rounded (feature, psi) rows."""
    high = F.col("psi") >= policy.feature_psi_threshold
    share = F.count_if(high) / F.count(F.lit(1))
    return psi.agg(
        F.count(F.lit(1)).alias("features"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "psi")))).alias(
            "by_feature"
        ),
        F.array_sort(F.collect_list(F.when(high, F.col("feature")))).alias("drifted"),
        F.round(share, 6).alias("drift_share"),
        (share >= policy.drift_share_threshold).alias("alert"),
    )


def numeric_distance(counts: DataFrame) -> DataFrame:
    """(feature, ks, distance): largest gap of the two distribution functions, and the area
    between them over the reference deviation (floored at 0.001)."""
    counts = counts.where("category IS NULL").drop("category")
    curves = running_totals(counts, "value", SIDES, ["feature"], with_next=True)
    gap = F.abs(
        F.try_divide("run_ref", "all_ref") - F.try_divide("run_cur", "all_cur")
    )
    area = gap * (F.coalesce("next_value", "value") - F.col("value"))
    value, n = F.col("value"), F.col("ref")
    mean = counts.groupBy("feature").agg((F.sum(value * n) / F.sum(n)).alias("mean"))
    squares = n * (value - F.col("mean")) * (value - F.col("mean"))
    return (
        curves.join(F.broadcast(mean), "feature")
        .groupBy("feature")
        .agg(
            F.max(gap).alias("ks"),
            F.sum(area).alias("area"),
            F.sqrt(F.sum(squares) / F.sum(n)).alias("deviation"),
        )
        .select(
            "feature",
            "ks",
            (F.col("area") / F.greatest("deviation", F.lit(0.001))).alias("distance"),
        )
    )


def category_distance(counts: DataFrame) -> DataFrame:
    """(feature, distance): base-2 Jensen-Shannon distance of the two category distributions."""
    counts = counts.where("category IS NOT NULL")
    totals = counts.groupBy("feature").agg(*[F.sum(s).alias(f"all_{s}") for s in SIDES])
    p, q = F.col("ref") / F.col("all_ref"), F.col("cur") / F.col("all_cur")
    middle = (p + q) / 2

    def divergence(share: Column) -> Column:
        return F.when(share > 0, share * F.log2(share / middle)).otherwise(0.0)

    total = F.sum(divergence(p) + divergence(q)) / 2
    return (
        counts.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.sqrt(F.greatest(total, F.lit(0.0))).alias("distance"))
    )


def column_distance(
    ref: DataFrame, cur: DataFrame, numeric: Sequence[str], text: Sequence[str], limit: float = 0.1
) -> DataFrame:
    """(feature, ks, distance, drifted): normalised Wasserstein or Jensen-Shannon distance."""
    counts = feature_counts(ref, cur, numeric, text)
    categories = category_distance(counts).withColumn("ks", F.lit(None).cast("double"))
    rows = numeric_distance(counts).unionByName(categories)
    return rows.withColumn("drifted", F.col("distance") >= limit)


def distance_summary(rows: DataFrame, share_limit: float) -> DataFrame:
    share = F.count_if("drifted") / F.count(F.lit(1))
    return rows.agg(
        F.count(F.lit(1)).alias("features"),
        share.alias("drift_share"),
        (share >= share_limit).alias("alert"),
    )


def prediction_drift_columns(
    reference_rate: Column, current_rate: Column, policy: Policy = Policy()
) -> dict[str, Column]:
    """``delta`` and ``alert``; without a rate on one side there is no delta and no alert."""
    delta = F.abs(current_rate - reference_rate)
    alert = F.coalesce(delta >= policy.prediction_rate_delta_threshold, F.lit(False))
    return {"delta": delta, "alert": alert}


def prediction_drift(
    ref: DataFrame, cur: DataFrame, score: str, policy: Policy = Policy()
) -> DataFrame:
    """(reference_rate, current_rate, delta, alert)."""
    rates = [positive_rate(side, score, policy.score_threshold) for side in (ref, cur)]
    row = rates[1].select(
        rates[0].scalar().alias("reference_rate"), F.col("positive_rate").alias("current_rate")
    )
    found = prediction_drift_columns(F.col("reference_rate"), F.col("current_rate"), policy)
    return row.withColumns(found)


def subgroup_rate(df: DataFrame, group: str, label: str) -> DataFrame:
    """(group, n, rate) of labelled rows for the groups 0 and 1; an absent group has no row."""
    member = F.col(group).try_cast("double")
    kept = df.where(member.isin(0.0, 1.0) & F.col(label).isNotNull())
    return kept.groupBy(member.cast("int").alias("group")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate")
    )


def group_columns(group: Column, label: Column) -> dict[str, Column]:
    """Aggregates n0, n1, rate0, rate1 of labelled rows."""
    out = {}
    for g in (0, 1):
        kept = F.when((group.try_cast("double") == g) & label.isNotNull(), label)
        out[f"n{g}"] = F.count(kept)
        out[f"rate{g}"] = F.avg(kept)
    return out


def effect_delta(ref: DataFrame, cur: DataFrame, group: str, label: str) -> DataFrame:
    """(baseline_effect, current_effect, delta): how much the gap between the groups moved."""

    def effect(df: DataFrame) -> DataFrame:
        return df.agg(effect_column(F.col(group), F.col(label)).alias("effect"))

    row = effect(cur).select(
        effect(ref).scalar().alias("baseline_effect"), F.col("effect").alias("current_effect")
    )
    return row.withColumn("delta", F.abs(F.col("current_effect") - F.col("baseline_effect")))


def delayed_performance(
    feedback: DataFrame, label: str, score: str, group: str, policy: Policy = Policy()
) -> DataFrame:
    """One row of metrics over rows that have both a label (0/1/NULL) and a score.

    Columns: labeled_rows, enough_labeled_rows, roc_auc, precision, recall, accuracy,
    positive_prediction_rate, n0, n1, rate0, rate1.
    """
    value = F.col(score).try_cast("double")
    scored = feedback.withColumn("_score", F.when(~F.isnan(value), value))
    valid = scored.where(F.col(label).isNotNull() & F.col("_score").isNotNull())
    counts = confusion_columns(F.col(label), F.col("_score"), policy.score_threshold)
    groups = group_columns(F.col(group), F.col(label))
    row = valid.agg(
        F.count(F.lit(1)).alias("labeled_rows"),
        *[c.alias(name) for name, c in {**counts, **groups}.items()],
    )
    auc = curve(score_points(valid, label, "_score")).agg(roc_auc_column())
    any_row = F.col("labeled_rows") > 0
    alerts = F.col("tp") + F.col("fp")
    return with_rates(row).select(
        "labeled_rows",
        (F.col("labeled_rows") >= policy.min_labeled_rows).alias("enough_labeled_rows"),
        auc.scalar().alias("roc_auc"),
        *[F.when(any_row, F.col(c)).alias(c) for c in ("precision", "recall", "accuracy")],
        F.when(any_row, alerts / F.col("labeled_rows")).alias("positive_prediction_rate"),
        *groups,
    )


def performance_alert(performance: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Add ``performance_alert``: too low a ranking quality, or too far below the baseline."""
    auc = F.col("roc_auc")
    low = auc < policy.min_roc_auc
    if policy.baseline_roc_auc is not None:
        low = low | (F.lit(policy.baseline_roc_auc) - auc >= policy.max_roc_auc_drop)
    alert = F.coalesce(F.col("enough_labeled_rows") & low, F.lit(False))
    return performance.withColumn("performance_alert", alert)


def effect_column(group: Column, label: Column) -> Column:
    """Aggregate: rate of group 1 minus rate of group 0, NULL unless both have labelled rows."""
    columns = group_columns(group, label)
    return columns["rate1"] - columns["rate0"]


def concept_drift(
    performance: DataFrame, baseline_effect: Column, policy: Policy = Policy()
) -> DataFrame:
    """Add effect_delta, performance_alert and concept_drift to a performance row.

    The effect counts only with enough labels overall and in both groups; a performance alert
    counts by itself.
    """
    row = performance_alert(performance, policy).withColumn("_base", baseline_effect)
    delta = F.abs(F.col("rate1") - F.col("rate0") - F.col("_base"))
    enough = F.col("enough_labeled_rows") & (F.least("n0", "n1") >= policy.min_group_rows)
    moved = F.coalesce(enough & (delta >= policy.effect_delta_threshold), F.lit(False))
    return (
        row.withColumn("effect_delta", delta)
        .withColumn("concept_drift", moved | F.col("performance_alert"))
        .drop("_base")
    )


# Actions, strongest first.
ACTIONS = ("RETRAIN", "WATCH", "WAIT_FOR_LABELS", "OK")

REASONS = {
    "RETRAIN": "labels confirm that the relation or the performance changed",
    "WATCH": "inputs or predictions moved; collect labels before retraining",
    "WAIT_FOR_LABELS": "too few labels to judge performance",
    "OK": "no limit was crossed",
}


def action_columns(
    concept: Column, data: Column, prediction: Column, label_state: Column
) -> dict[str, Column]:
    """``action`` and ``reason`` from the alerts; NULL alerts count as no alert."""
    no = F.lit(False)
    action = (
        F.when(F.coalesce(concept, no), "RETRAIN")
        .when(F.coalesce(data, no) | F.coalesce(prediction, no), "WATCH")
        .when(label_state == "not_enough_labels", "WAIT_FOR_LABELS")
        .otherwise("OK")
    )
    reason = F.lit(REASONS["OK"])
    for name in ACTIONS[:-1]:
        reason = F.when(action == name, REASONS[name]).otherwise(reason)
    return {"action": action, "reason": reason}


def shift_covariates(
    df: DataFrame, age: str = "age", group: str = "sms_received", years: int = 20, top: int = 115
) -> DataFrame:
    """Drifted inputs: everybody older (capped), everybody in the group."""
    older = F.col(age) + years
    return df.withColumns({age: F.when(older > top, top).otherwise(older), group: F.lit(1)})


def shift_concept(
    df: DataFrame, group: str = "sms_received", label: str = "no_show", positive: str = "Yes"
) -> DataFrame:
    """Drifted outcomes: everybody in the group gets the positive label."""
    return df.withColumn(label, F.when(F.col(group) == 1, positive).otherwise(F.col(label)))


def build_feedback(
    predictions: DataFrame, outcomes: DataFrame, key: str, predicted_at: str, outcome_at: str
) -> DataFrame:
    """Predictions with the outcome that became known after them.

    One prediction log may hold many rows per key; outcomes have one. Keys with very many
    predictions are spread over several tasks.
    """
    counts = predictions.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    extra = [c for c in outcomes.columns if c not in predictions.columns]
    known = outcomes.select(key, *extra).join(counts, key)
    joined = lookup_join(predictions, known, [key], "_rows", how="inner")
    late = F.col(outcome_at) >= F.col(predicted_at)
    return joined.where(late).select(*predictions.columns, *extra)
