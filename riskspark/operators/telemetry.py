"""Service telemetry: window aggregates, quantiles, held alerts and targets.

Raw logs are reduced to small window rows first; sliding windows and quantiles work on those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions import count_rows, ratio
from riskspark.operators.ordered import exact_quantiles, quantiles_of_counts
from riskspark.schema import Slo

INF = float("inf")

# Upper bucket bounds of scores, batch sizes and stage times (seconds).
SCORE_BUCKETS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, INF]
BATCH_BUCKETS = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0, 1000.0, INF]
STAGE_BUCKETS = [
    0.0005, 0.001, 0.002, 0.003, 0.005, 0.0075, 0.01, 0.015, 0.02, 0.03, 0.04, 0.05, 0.06,
    0.075, 0.1, 0.15, 0.2, 0.3, 0.5, 1.0, 2.5, INF,
]
LATENCY_QUANTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def window_start(ts: str | Column, length: str) -> Column:
    return F.window(ts, length)["start"].alias("window_start")


def alerts_per_window(
    log: DataFrame, ts: str = "ts", alert: str = "alert", length: int = 3600, slide: int = 300
) -> DataFrame:
    """(window_start, alert, n) over sliding windows, in seconds.

    Rows are counted once per slide; the slide counts, not the rows, go into each of their
    windows.
    """
    slot = F.window(ts, f"{slide} seconds")["start"]
    slots = log.groupBy(slot.alias("slot"), alert).agg(count_rows().alias("n"))
    back = F.sequence(F.lit(0), F.lit(length - slide), F.lit(slide))
    spread = slots.withColumn("back", F.explode(back)).select(
        F.timestamp_seconds(F.unix_timestamp("slot") - F.col("back")).alias("window_start"),
        alert,
        "n",
    )
    return spread.groupBy("window_start", alert).agg(F.sum("n").alias("n"))


def histogram(
    df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str | Column] = ()
) -> DataFrame:
    """(by..., le, n): cumulative counts of values up to each bound, from one pass."""
    counts = [
        F.struct(
            F.lit(float(b)).alias("le"), F.count_if(F.col(value) <= F.lit(float(b))).alias("n")
        )
        for b in bounds
    ]
    wide = df.groupBy(*by).agg(F.array(*counts).alias("_h"))
    names = [c for c in wide.columns if c != "_h"]
    return wide.select(*names, F.inline("_h"))


def score_histogram(
    log: DataFrame, ts: str = "ts", score: str = "score", length: str = "1 hour"
) -> DataFrame:
    return histogram(log, score, SCORE_BUCKETS, [window_start(ts, length)])


def window_quantiles(
    log: DataFrame,
    value: str,
    probs: dict[str, float],
    ts: str = "ts",
    length: str = "5 minutes",
    by: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """(window_start, by..., quantiles). ``exact=False`` keeps a small sketch per window."""
    rows = log.where(F.col(value).isNotNull()).withColumn("window_start", window_start(ts, length))
    groups = ["window_start", *by]
    if exact:
        return exact_quantiles(rows, value, probs, groups)
    return rows.groupBy(*groups).agg(
        *[F.percentile_approx(value, p, 10000).alias(name) for name, p in probs.items()]
    )


def score_quantiles(log: DataFrame, ts: str = "ts", score: str = "score") -> DataFrame:
    return window_quantiles(log, score, {"p50": 0.5, "p95": 0.95}, ts, "1 hour")


def latency_quantiles(log: DataFrame, ts: str = "ts", latency: str = "latency_ms") -> DataFrame:
    return window_quantiles(log, latency, LATENCY_QUANTILES, ts, "5 minutes")


def throughput(
    log: DataFrame, ts: str = "ts", path: str = "path", seconds: int = 300
) -> DataFrame:
    """(window_start, path, per_second)."""
    counts = log.groupBy(window_start(ts, f"{seconds} seconds"), path).agg(count_rows().alias("n"))
    return counts.select("window_start", path, (F.col("n") / float(seconds)).alias("per_second"))


def error_rate(
    log: DataFrame, ts: str = "ts", status: str = "status", seconds: int = 300
) -> DataFrame:
    """(window_start, error_rate): failures per second over requests per second.

    The request rate counts as at least 0.001 per second.
    """
    counts = log.groupBy(window_start(ts, f"{seconds} seconds")).agg(
        count_rows().alias("n"), F.count_if(F.col(status) >= 500).alias("failed")
    )
    rate = F.greatest(F.col("n") / float(seconds), F.lit(0.001))
    return counts.select(
        "window_start", (F.col("failed") / float(seconds) / rate).alias("error_rate")
    )


def hold_alert(
    series: DataFrame,
    condition: Column,
    hold_seconds: int,
    step_seconds: int,
    ts: str = "window_start",
    by: Sequence[str] = (),
    bucket_seconds: int = 86_400,
) -> DataFrame:
    """(by..., started_at, fired_at, ended_at) per spell in which the condition held long enough.

    A spell ends when the condition fails or a step is missing. A series is cut into time buckets, which
    hand on their last row and their last start by one row each, so a series of any length
    spreads over as many tasks as it has buckets.
    """
    at = F.unix_timestamp(ts)
    held = series.where(condition).select(*by, ts, at.alias("_at"), F.floor(at / bucket_seconds).alias("_bucket"))
    keys = [*by, "_bucket"]
    buckets = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket")
    inside = Window.partitionBy(*keys).orderBy("_at")

    def handed_on(rows: DataFrame, last: Column, name: str) -> DataFrame:
        """The newest value of the buckets before, at every row."""
        ends = rows.groupBy(*keys).agg(F.max(last).alias("_end"))
        earlier = buckets.rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select(*keys, F.max("_end").over(earlier).alias(name))
        match = [F.col(f"r.`{k}`").eqNullSafe(F.col(f"e.`{k}`")) for k in keys]
        return rows.alias("r").join(ends.alias("e"), match).select("r.*", f"e.{name}")

    rows = handed_on(held, F.col("_at"), "_carried")
    before = F.coalesce(F.lag("_at").over(inside), F.col("_carried"))
    starts = F.when(before.isNull() | (F.col("_at") - before > step_seconds), F.col("_at"))
    rows = handed_on(rows.withColumn("_start", starts), F.col("_start"), "_open")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spells = rows.withColumn("_spell", F.coalesce(F.max("_start").over(so_far), F.col("_open")))
    ends = spells.groupBy(*by, "_spell").agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("ended_at")
    )
    start = F.unix_timestamp("started_at")
    return ends.where(F.unix_timestamp("ended_at") - start >= hold_seconds).select(
        *by, "started_at", F.timestamp_seconds(start + hold_seconds).alias("fired_at"), "ended_at"
    )


def staleness(
    reports: DataFrame, now: Column, ts: str = "generated_at", limit_seconds: int = 86_400
) -> DataFrame:
    """(latest, age_seconds, missing, stale)."""
    row = reports.agg(F.max(ts).alias("latest"))
    age = F.unix_timestamp(now) - F.unix_timestamp("latest")
    return row.select(
        "latest",
        age.alias("age_seconds"),
        F.col("latest").isNull().alias("missing"),
        F.coalesce(age > limit_seconds, F.lit(False)).alias("stale"),
    )


def histogram_quantile(
    buckets: DataFrame, probs: dict[str, float], by: Sequence[str], le: str = "le", n: str = "n"
) -> DataFrame:
    """(by..., quantiles) from cumulative buckets, linear inside a bucket.

    In the open bucket the answer is its lower bound; an empty histogram gives NaN. A group
    has as many rows as bounds.
    """
    order = Window.partitionBy(*by).orderBy(le)
    group = Window.partitionBy(*by)
    rows = buckets.select(
        *by,
        F.col(le).alias("_le"),
        F.col(n).cast("double").alias("_n"),
        F.coalesce(F.lag(le).over(order), F.lit(0.0)).alias("_low"),
        F.coalesce(F.lag(n).over(order), F.lit(0)).cast("double").alias("_below"),
        F.coalesce(F.max(F.when(F.col(le) == INF, F.col(n))).over(group), F.lit(0))
        .cast("double")
        .alias("_total"),
    )
    out = []
    for name, q in probs.items():
        target = F.col("_total") * q
        span = F.col("_n") - F.col("_below")
        part = F.coalesce(F.try_divide(target - F.col("_below"), span), F.lit(0.0))
        inside = F.when(F.col("_le") == INF, F.col("_low")).otherwise(
            F.col("_low") + (F.col("_le") - F.col("_low")) * part
        )
        first = F.min_by(inside, F.when(F.col("_n") >= target, F.col("_le")))
        out.append(F.when(F.max("_total") > 0, first).otherwise(float("nan")).alias(name))
    return rows.groupBy(*by).agg(*out)


def counter_delta(
    before: DataFrame, after: DataFrame, keys: Sequence[str], value: str = "value"
) -> DataFrame:
    """After minus before per series; a series that was not there before counted from 0.

    A counter that is smaller than before was restarted and has counted from 0 since.
    """
    old = before.select(*keys, F.col(value).alias("_old"))
    match = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
    joined = after.alias("a").join(old.alias("b"), match, "left")
    delta = _grown(F.col(f"a.`{value}`"), F.coalesce("b._old", F.lit(0)))
    return joined.select(*[F.col(f"a.`{k}`") for k in keys], delta.alias("delta"))


def _grown(value: Column, before: Column) -> Column:
    return F.when(value < before, value).otherwise(value - before)


def _with_growth(
    scrapes: DataFrame, keys: Sequence[str], ts: str, value: str, first: Column | None, bucket: int
) -> DataFrame:
    """Scrapes with ``_bucket``, and ``_growth`` since the scrape before; ``first`` is that of the first one.

    A series is cut into time buckets; what the bucket before ended with comes from one row per
    bucket, so a series of any length spreads over as many tasks as it has buckets.
    """
    known = scrapes.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
    rows = known.withColumn("_bucket", F.floor(F.unix_timestamp(ts) / bucket))
    ends = rows.groupBy(*keys, "_bucket").agg(F.max_by(value, ts).alias("_end"))
    in_order = Window.partitionBy(*keys).orderBy("_bucket")
    ends = ends.withColumn("_carried", F.lag("_end").over(in_order)).drop("_end")
    match = [F.col(f"r.`{k}`").eqNullSafe(F.col(f"e.`{k}`")) for k in [*keys, "_bucket"]]
    joined = rows.alias("r").join(ends.alias("e"), match).select("r.*", "e._carried")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(ts)
    before = F.coalesce(F.lag(value).over(inside), F.col("_carried"))
    growth = F.when(before.isNull(), F.col(value) if first is None else first)
    return joined.withColumn("_growth", growth.otherwise(_grown(F.col(value), before))).drop("_carried")


def counter_increase(
    scrapes: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value", bucket_seconds: int = 86_400
) -> DataFrame:
    """(keys..., ts, delta): growth since the previous scrape of each series, for many scrapes.

    The first scrape counts from 0, and so does one with a smaller value than before: the
    process was restarted. Missing scrapes and NULL values only make a step longer.
    """
    grown = _with_growth(scrapes, keys, ts, value, None, bucket_seconds)
    return grown.select(*keys, ts, F.col("_growth").alias("delta"))


def counter_rates(
    scrapes: DataFrame,
    keys: Sequence[str],
    window_seconds: int = 300,
    ts: str = "ts",
    value: str = "value",
    bucket_seconds: int = 86_400,
) -> DataFrame:
    """(keys..., ts, total, increase, per_second, scrapes) at every scrape.

    ``total`` is the running increase since the first scrape, restarts included. ``increase`` is its
    growth since the first scrape of the window (ts - window_seconds, ts], ``per_second`` that over
    the time between the two, NULL where the window holds only one scrape. Whole seconds count.

    Totals are prefix sums inside time buckets, shifted by the sums of the buckets before; a
    window that reaches back into the bucket before finds that bucket's last rows repeated.
    """
    if window_seconds > bucket_seconds:
        raise ValueError("a window is no longer than a bucket")
    grown = _with_growth(scrapes, keys, ts, value, F.lit(0), bucket_seconds)
    sums = grown.groupBy(*keys, "_bucket").agg(F.sum("_growth").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    summed = grown.withColumn("_in", F.sum("_growth").over(inside))
    match = [F.col(f"r.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in [*keys, "_bucket"]]
    totals = summed.alias("r").join(sums.alias("s"), match).select(
        *[F.col(f"r.`{k}`") for k in keys],
        F.col(f"r.`{ts}`").alias(ts),
        "r._bucket",
        F.unix_timestamp(f"r.{ts}").alias("_at"),
        (F.col("_in") + F.col("_before")).alias("total"),
    )
    left = (F.col("_bucket") + 1) * bucket_seconds - F.col("_at")
    both = totals.withColumn(
        "_seen_in",
        F.explode(F.when(left < window_seconds, F.array(F.col("_bucket"), F.col("_bucket") + 1)).otherwise(F.array("_bucket"))),
    )
    window = Window.partitionBy(*keys, "_seen_in").orderBy("_at").rangeBetween(-(window_seconds - 1), 0)
    rows = both.select(
        "*",
        F.first("total").over(window).alias("_first"),
        F.first("_at").over(window).alias("_since"),
        F.count(F.lit(1)).over(window).alias("scrapes"),
    ).where(F.col("_seen_in") == F.col("_bucket"))
    increase = F.col("total") - F.col("_first")
    return rows.select(
        *keys,
        ts,
        "total",
        increase.alias("increase"),
        F.try_divide(increase.cast("double"), (F.col("_at") - F.col("_since")).cast("double")).alias("per_second"),
        "scrapes",
    )


def stage_breakdown(
    samples: DataFrame,
    stages: Sequence[str],
    stage: str = "stage",
    size: str = "rows",
    seconds: str = "seconds",
) -> DataFrame:
    """(rows, stage, p50, p95, mean, share): nearest-rank quantiles, share of the named stages."""
    counts = samples.groupBy(size, stage, F.col(seconds).cast("double").alias("_s")).agg(
        count_rows().alias("n"), F.sum(seconds).alias("_sum")
    )
    ranked = quantiles_of_counts(
        counts, "_s", {"p50": 0.5, "p95": 0.95}, [size, stage], method="nearest"
    )
    means = counts.groupBy(size, stage).agg((F.sum("_sum") / F.sum("n")).alias("mean"))
    named = F.col(stage).isin(list(stages))
    total = F.sum(F.when(named, F.col("mean"))).over(Window.partitionBy(size))
    shares = means.withColumn("share", F.when(named, F.try_divide("mean", total)))
    return ranked.join(shares, [size, stage]).select(size, stage, "p50", "p95", "mean", "share")


def endpoint_table(
    log: DataFrame,
    path: str = "path",
    ts: str = "ts",
    status: str = "status",
    latency: str = "latency_ms",
    by: Sequence[str] = (),
) -> DataFrame:
    """(by..., endpoint, requests, failures, rps, p50_ms, p95_ms, p99_ms, error_rate).

    One row per path and an ``Aggregated`` row per group; both come from the same counts per
    distinct latency.
    """
    by = list(by)
    counts = log.groupBy(*by, F.col(path).alias("endpoint"), F.col(latency).alias("_v")).agg(
        count_rows().alias("n"),
        F.count_if(F.col(status) >= 500).alias("failed"),
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
    )
    names = F.explode(F.array("endpoint", F.lit("Aggregated")))
    both = counts.withColumn("endpoint", names)
    groups = [*by, "endpoint"]
    points = both.where(F.col("_v").isNotNull()).groupBy(*groups, "_v").agg(F.sum("n").alias("n"))
    quantiles = quantiles_of_counts(
        points, "_v", {f"{k}_ms": p for k, p in LATENCY_QUANTILES.items()}, groups
    )
    totals = both.groupBy(*groups).agg(
        F.sum("n").alias("requests"),
        F.sum("failed").alias("failures"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    span = (F.unix_micros("last") - F.unix_micros("first")) / 1e6
    joined = totals.alias("t").join(
        quantiles.alias("q"), [F.col(f"t.`{c}`").eqNullSafe(F.col(f"q.`{c}`")) for c in groups], "left"
    )
    return joined.select(
        *[F.col(f"t.`{c}`") for c in groups],
        "requests",
        "failures",
        F.try_divide(F.col("requests").cast("double"), span).alias("rps"),
        "p50_ms",
        "p95_ms",
        "p99_ms",
        ratio(F.col("failures"), F.col("requests")).alias("error_rate"),
    )


def _one_row_per_run(stats: DataFrame, endpoint: str, run: str) -> DataFrame:
    """Latencies of the endpoint and totals of the ``Aggregated`` row."""
    main, whole = F.col("endpoint") == endpoint, F.col("endpoint") == "Aggregated"
    columns = [
        F.max(F.when(main, F.col(c))).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms")
    ] + [F.max(F.when(whole, F.col(c))).alias(c) for c in ("requests", "rps", "error_rate")]
    return stats.groupBy(run).agg(*columns)


def slo_report(
    stats: DataFrame, endpoint: str, slo: Slo = Slo(), run: str = "run"
) -> DataFrame:
    """(run, slo, measured, target, result): latency of one endpoint, errors of all."""
    row = _one_row_per_run(stats, endpoint, run)
    checks = [
        ("p50 latency", F.col("p50_ms"), slo.latency_p50_ms, True),
        ("p95 latency", F.col("p95_ms"), slo.latency_p95_ms, True),
        ("error rate", F.col("error_rate"), slo.error_rate_max, True),
        ("availability", 1 - F.col("error_rate"), slo.availability_min, False),
    ]
    structs = []
    for name, value, target, at_most in checks:
        ok = value <= target if at_most else value >= target
        structs.append(
            F.struct(
                F.lit(name).alias("slo"),
                value.alias("measured"),
                F.lit(float(target)).alias("target"),
                F.when(ok, "PASS").otherwise("FAIL").alias("result"),
            )
        )
    return row.select(run, F.inline(F.array(*structs)))


def run_comparison(
    stats: DataFrame, endpoint: str, slo: Slo = Slo(), run: str = "run"
) -> DataFrame:
    """One row per run: latencies, total rate, errors, and which latency targets hold."""

    def mark(name: str, target: float) -> Column:
        return F.when(F.col(name) <= target, "PASS").otherwise("FAIL")

    return (
        _one_row_per_run(stats, endpoint, run)
        .select(
            run,
            "p50_ms",
            "p95_ms",
            "p99_ms",
            "rps",
            "error_rate",
            mark("p50_ms", slo.latency_p50_ms).alias("p50_result"),
            mark("p95_ms", slo.latency_p95_ms).alias("p95_result"),
        )
        .orderBy(run)
    )


def batch_sizes(log: DataFrame, call: Sequence[str | Column]) -> DataFrame:
    """(rows) per scoring call."""
    return log.groupBy(*call).agg(count_rows().cast("double").alias("rows"))


def batch_size_distribution(log: DataFrame, call: Sequence[str | Column]) -> DataFrame:
    """(le, n, calls, mean_rows): cumulative calls by size, with the totals on each row."""
    sizes = batch_sizes(log, call).groupBy("rows").agg(count_rows().alias("calls"))
    counts = F.array(
        *[
            F.struct(
                F.lit(b).alias("le"),
                F.sum(F.when(F.col("rows") <= F.lit(b), F.col("calls")).otherwise(0)).alias("n"),
            )
            for b in BATCH_BUCKETS
        ]
    )
    row = sizes.agg(
        F.sum("calls").alias("calls"),
        (F.sum(F.col("rows") * F.col("calls")) / F.sum("calls")).alias("mean_rows"),
        counts.alias("h"),
    )
    return row.select(F.inline("h"), "calls", "mean_rows")


