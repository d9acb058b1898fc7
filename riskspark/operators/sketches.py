"""Quantiles from sketches that are kept per small window and merged into larger ones.

A five-minute table of sketches stands for the log: hours and days come from it alone, at a bounded
rank error, and a late row only adds one more sketch to its window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import count_rows

# Size parameter of the sketches. A quantile's rank is off by at most RANK_ERROR of the rows, with 99 % confidence.
K = 800
RANK_ERROR = 0.0045


def sketch_windows(
    log: DataFrame,
    value: str,
    ts: str = "ts",
    length: str = "5 minutes",
    by: Sequence[str] = (),
    k: int = K,
    late: str | None = None,
) -> DataFrame:
    """(window_start, by..., n, low, high, sketch): rows, extremes and quantile sketch of every window.

    NULL and NaN values are left out. With ``late`` the log is a stream, and a window is handed
    on once, when the watermark has passed it.
    """
    column = F.col(value).cast("double")
    rows = log.withWatermark(ts, late) if late else log
    windows = (
        rows.where(column.isNotNull() & ~F.isnan(column))
        .groupBy(F.window(ts, length).alias("_window"), *by)
        .agg(
            count_rows().alias("n"),
            F.min(column).alias("low"),
            F.max(column).alias("high"),
            F.kll_sketch_agg_double(column, k).alias("sketch"),
        )
    )
    return windows.select(F.col("_window.start").alias("window_start"), *by, "n", "low", "high", "sketch")


def roll_up(sketches: DataFrame, length: str, by: Sequence[str] = ()) -> DataFrame:
    """The same columns for windows of ``length``; groups not named in ``by`` are merged too."""
    start = F.window("window_start", length)["start"].alias("window_start")
    return sketches.groupBy(start, *by).agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def sketch_quantiles(sketches: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Quantile columns in place of the sketches; the extremes are exact."""

    def at(p: float) -> Column:
        if p in (0.0, 1.0):
            return F.col("high" if p else "low")
        return F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))

    others = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*others, *[at(p).alias(name) for name, p in probs.items()])


def rank_errors(
    log: DataFrame,
    quantiles: DataFrame,
    value: str,
    probs: dict[str, float],
    length: str,
    ts: str = "ts",
    by: Sequence[str] = (),
) -> DataFrame:
    """(window_start, by..., rows, errors...): how far each quantile's rank is off, as a share of the rows.

    A value that many rows share has all of their ranks, so the nearest one counts.
    """
    start = F.window(ts, length)["start"].alias("window_start")
    column = F.col(value).cast("double")
    rows = log.where(column.isNotNull() & ~F.isnan(column)).select(start, *by, column.alias("_v"))
    keys = ["window_start", *by]
    # One row per window and group on this side.
    joined = rows.join(quantiles.select(*keys, *probs), keys)
    counts = [count_rows().alias("rows")]
    for name in probs:
        counts += [F.count_if(F.col("_v") < F.col(name)).alias(f"_{name}"), F.count_if(F.col("_v") <= F.col(name)).alias(f"_{name}2")]
    found = joined.groupBy(*keys).agg(*counts)

    def error(name: str, p: float) -> Column:
        below, upto = F.col(f"_{name}") / F.col("rows"), F.col(f"_{name}2") / F.col("rows")
        return F.greatest(F.lit(0.0), below - p, p - upto).alias(f"{name}_error")

    return found.select(*keys, "rows", *[error(n, p) for n, p in probs.items()])
