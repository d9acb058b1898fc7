"""Release gates: is a candidate good enough, and better than the version in use?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import ratio
from riskspark.schema import Gate


def _failures(*checks: tuple[Column, str]) -> Column:
    """Names of the checks that did not pass; a NULL check did not pass."""
    found = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for ok, text in checks]
    return F.filter(F.array(*found), lambda f: f.isNotNull())


def _verdict(df: DataFrame) -> DataFrame:
    return df.withColumn("passed", F.size("failures") == 0)


def gate_absolute(
    results: DataFrame,
    selected: str,
    data_version: str,
    expected_model: str,
    expected_data: str,
    gate: Gate = Gate(),
) -> DataFrame:
    """Check recorded metrics, long (experiment, metric, value), of the selected experiment."""
    row = results.where(F.col("experiment") == selected).agg(
        F.max(F.when(F.col("metric") == "val_pr_auc", F.col("value"))).alias("pr_auc"),
        F.max(F.when(F.col("metric") == "val_recall", F.col("value"))).alias("recall"),
    )
    known = F.lit(selected == expected_model)
    same_data = F.lit(data_version == expected_data)
    recorded = F.col("pr_auc").isNotNull() & F.col("recall").isNotNull()
    return _verdict(
        row.withColumn(
            "failures",
            _failures(
                (known, "not the selected model"),
                (same_data, "other data version"),
                (recorded, "no metrics recorded"),
                (~recorded | (F.col("pr_auc") >= gate.min_pr_auc), "PR-AUC below minimum"),
                (~recorded | (F.col("recall") >= gate.min_recall), "recall below minimum"),
            ),
        ).select(F.lit(selected).alias("experiment"), "pr_auc", "recall", "failures")
    )


def gate_experiments(table: DataFrame, gate: Gate = Gate()) -> DataFrame:
    """The absolute limits for every experiment of a wide metric table at once."""
    return _verdict(
        table.withColumn(
            "failures",
            _failures(
                (F.col("val_pr_auc") >= gate.min_pr_auc, "PR-AUC below minimum"),
                (F.col("val_recall") >= gate.min_recall, "recall below minimum"),
            ),
        )
    )


def gate_size(size: DataFrame, gate: Gate = Gate()) -> DataFrame:
    """``size`` has one column ``size_mb``."""
    small = F.col("size_mb") <= gate.max_model_size_mb
    return _verdict(size.withColumn("failures", _failures((small, "model too large"))))


def gate_relative(
    scored: DataFrame,
    label: str,
    candidate: str,
    candidate_threshold: float,
    champion: str | None = None,
    champion_threshold: float = 0.5,
) -> DataFrame:
    """Recall of candidate and champion on the same rows; equal is not better.

    Without a champion there is nothing to compare and the gate passes.
    """
    yes = F.col(label) == 1

    def recall(score: str, threshold: float) -> Column:
        return ratio(F.count_if(yes & (F.col(score) >= threshold)), F.count_if(yes))

    old = F.lit(None).cast("double") if champion is None else recall(champion, champion_threshold)
    row = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        recall(candidate, candidate_threshold).alias("candidate_recall"),
        old.alias("champion_recall"),
    )
    better = F.col("champion_recall").isNull() | (
        F.col("candidate_recall") > F.col("champion_recall")
    )
    return _verdict(
        row.withColumn("failures", _failures((better, "recall not above the champion")))
    )


def gate_preconditions(records: DataFrame) -> DataFrame:
    """Check version records before any metric counts.

    Columns: version, status, run_status, data_version, gate_data_version, threshold,
    recorded_threshold, pr_auc, recall.
    """

    def finite(name: str) -> Column:
        value = F.col(name)
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))

    limit = F.col("threshold")
    return _verdict(
        records.withColumn(
            "failures",
            _failures(
                (F.col("status") == "READY", "version not ready"),
                (F.col("run_status") == "FINISHED", "run not finished"),
                (F.col("data_version") == F.col("gate_data_version"), "other data version"),
                (finite("threshold") & limit.between(0, 1), "invalid threshold"),
                (limit == F.col("recorded_threshold"), "threshold differs from evaluation"),
                (finite("pr_auc"), "pr_auc not finite"),
                (finite("recall"), "recall not finite"),
            ),
        )
    )


def resolve_alias(
    log: DataFrame, default_threshold: float = 0.5, override: float | None = None
) -> DataFrame:
    """(name, alias, version, threshold) in force, from a log of alias moves.

    The latest move wins, equal times go to the higher version. The threshold is the override,
    else the one recorded with the version, else the default.
    """
    latest = F.max_by(F.struct("version", "threshold"), F.struct("ts", "version"))
    threshold = F.coalesce(
        F.lit(override).cast("double"), F.col("m.threshold"), F.lit(float(default_threshold))
    )
    return (
        log.groupBy("name", "alias")
        .agg(latest.alias("m"))
        .select("name", "alias", F.col("m.version").alias("version"), threshold.alias("threshold"))
    )


def score_parity(
    served: DataFrame, local: DataFrame, key: str, threshold: float, tolerance: float = 1e-6
) -> DataFrame:
    """One row: do served predictions (score, alert, model_version) equal local scores?

    Rows found on one side only are counted, and fail the check.
    """
    nothing, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    both = served.select(
        key, F.col("score").alias("s"), F.col("alert").alias("a"),
        F.col("model_version").alias("v"), nothing.alias("p"), F.lit(1).alias("in_s"),
        F.lit(0).alias("in_p"),
    ).unionByName(
        local.select(
            key, nothing.alias("s"), F.lit(None).cast("boolean").alias("a"), text.alias("v"),
            F.col("score").alias("p"), F.lit(0).alias("in_s"), F.lit(1).alias("in_p"),
        )
    )
    # Grouped rather than joined: a key repeated many times combines on the map side. NaN sorts
    # above all numbers, so it shows in the larger end.
    keys = both.groupBy(key).agg(
        F.sum("in_s").alias("in_s"),
        F.sum("in_p").alias("in_p"),
        *[f(c).alias(f"{name}_{c}") for c in "sp" for name, f in (("low", F.min), ("high", F.max))],
        F.min("a").alias("low_a"),
        F.max("a").alias("high_a"),
        F.count("s").alias("scores"),
        F.min("v").alias("low_v"),
        F.max("v").alias("high_v"),
    )
    gap = F.greatest(
        F.abs(F.col("high_s") - F.col("low_p")), F.abs(F.col("high_p") - F.col("low_s"))
    )
    wrong_alert = (F.col("low_a") != (F.col("high_p") >= threshold)) | (
        F.col("high_a") != (F.col("low_p") >= threshold)
    )
    versions = F.array_distinct(
        F.flatten(F.collect_set(F.array("low_v", "high_v")))
    )
    row = keys.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.when(~F.isnan(gap), gap)).alias("max_difference"),
        F.count_if(wrong_alert).alias("alert_mismatches"),
        F.sum(
            F.when(F.isnan("high_s"), 1).otherwise(0) + F.col("in_s") - F.col("scores")
        ).alias("missing_scores"),
        F.count_if(F.col("in_s") != F.col("in_p")).alias("unmatched"),
        F.array_join(F.array_sort(versions), ",").alias("versions"),
    )
    ok = (
        (F.coalesce("max_difference", F.lit(0.0)) <= tolerance)
        & (F.col("alert_mismatches") == 0)
        & (F.col("missing_scores") == 0)
        & (F.col("unmatched") == 0)
    )
    return row.withColumn("parity", ok)
