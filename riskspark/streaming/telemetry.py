"""Streaming forms of the window aggregates. Late rows are dropped after the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.operators.telemetry import SCORE_BUCKETS


def alerts_per_window_stream(
    log: DataFrame,
    ts: str = "ts",
    alert: str = "alert",
    length: str = "1 hour",
    slide: str = "5 minutes",
    late: str = "10 minutes",
) -> DataFrame:
    windows = F.window(ts, length, slide)
    counts = log.withWatermark(ts, late).groupBy(windows, alert).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), alert, "n")


def service_windows_stream(
    log: DataFrame,
    ts: str = "ts",
    status: str = "status",
    latency: str = "latency_ms",
    seconds: int = 300,
    late: str = "10 minutes",
) -> DataFrame:
    """(window_start, per_second, error_rate, p50, p95, p99) with small quantile sketches."""
    rows = log.withWatermark(ts, late).groupBy(F.window(ts, f"{seconds} seconds"))
    wide = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(status) >= 500).alias("failed"),
        F.percentile_approx(latency, [0.5, 0.95, 0.99], 10000).alias("q"),
    )
    rate = F.col("n") / float(seconds)
    return wide.select(
        F.col("window.start").alias("window_start"),
        rate.alias("per_second"),
        (F.col("failed") / float(seconds) / F.greatest(rate, F.lit(0.001))).alias("error_rate"),
        *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(("p50", "p95", "p99"))],
    )


def score_histogram_stream(
    log: DataFrame, ts: str = "ts", score: str = "score", length: str = "1 hour", late: str = "10 minutes"
) -> DataFrame:
    counts = [F.count_if(F.col(score) <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(SCORE_BUCKETS)]
    wide = log.withWatermark(ts, late).groupBy(F.window(ts, length)).agg(*counts)
    rows = [
        F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(SCORE_BUCKETS)
    ]
    return wide.select(F.col("window.start").alias("window_start"), F.inline(F.array(*rows)))


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write closed windows once each; runs until the input present at the start is read."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
