"""Service telemetry over the request log."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators import sketches as K
from riskspark.operators import telemetry as T
from riskspark.plans.adapter import requests
from riskspark.plans.queries.base import REQ, query, r6, stamp
from riskspark.plans.queries.sourcing import HOURS, RUNS, runs
from riskspark.session import materialize

_AT = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"
_FIVE = "time_bucket(INTERVAL 5 MINUTE, ts)"


def log(spark, sf_dir):
    return requests(spark, sf_dir).withColumn("alert", F.col("score") >= 0.5)


@query(
    "alerts_per_sliding_hour",
    f"""WITH {REQ}, w AS (SELECT {_FIVE} - to_minutes(CAST(5 * i AS INTEGER)) AS window_start, score >= 0.5 AS alert
      FROM req, range(12) t(i)) SELECT {_AT}, alert, count(*) AS n FROM w GROUP BY 1, 2""",
)
def alerts_per_sliding_hour(spark, sf_dir):
    found = T.alerts_per_window(log(spark, sf_dir))
    return stamp(found, "window_start")


@query(
    "score_histogram",
    f"""WITH {REQ}, {HOURS} SELECT {_AT}, CASE WHEN isinf(le) THEN 'inf' ELSE CAST(le AS VARCHAR) END AS le, n FROM hist""",
)
def score_histogram(spark, sf_dir):
    found = stamp(T.score_histogram(requests(spark, sf_dir)), "window_start")
    bound = F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("string"))
    return found.withColumn("le", bound)


@query(
    "score_quantiles",
    f"""WITH {REQ}, w AS (SELECT date_trunc('hour', ts) AS window_start, round(quantile_cont(score, 0.5), 6) AS p50,
      round(quantile_cont(score, 0.95), 6) AS p95 FROM req GROUP BY 1) SELECT {_AT}, p50, p95 FROM w""",
)
def score_quantiles(spark, sf_dir):
    found = T.score_quantiles(requests(spark, sf_dir))
    return r6(stamp(found, "window_start"), "p50", "p95")


def bucket_quantile_sql(q: float) -> str:
    return f"""first_value(CASE WHEN isinf(le) THEN low ELSE low + (le - low)
      * (CASE WHEN n = below THEN 0 ELSE ({q} * total - below) / (n - below) END) END)
      OVER (PARTITION BY window_start ORDER BY CASE WHEN n >= {q} * total THEN le ELSE NULL END NULLS LAST)"""


@query(
    "score_quantiles_from_buckets",
    f"""WITH {REQ}, {HOURS}, b AS (SELECT window_start, le, CAST(n AS DOUBLE) AS n,
        coalesce(lag(le) OVER w, 0) AS low, CAST(coalesce(lag(n) OVER w, 0) AS DOUBLE) AS below,
        CAST(max(n) OVER (PARTITION BY window_start) AS DOUBLE) AS total FROM hist
        WINDOW w AS (PARTITION BY window_start ORDER BY le)),
      q AS (SELECT DISTINCT window_start, {bucket_quantile_sql(0.5)} AS p50, {bucket_quantile_sql(0.95)} AS p95 FROM b)
    SELECT {_AT}, round(p50, 6) AS p50, round(p95, 6) AS p95 FROM q""",
)
def score_quantiles_from_buckets(spark, sf_dir):
    """What a dashboard shows: quantiles interpolated in the hourly score histogram."""
    buckets = T.score_histogram(requests(spark, sf_dir))
    found = T.histogram_quantile(buckets, {"p50": 0.5, "p95": 0.95}, ["window_start"])
    return r6(stamp(found, "window_start"), "p50", "p95")


@query(
    "throughput",
    f"""WITH {REQ}, w AS (SELECT {_FIVE} AS window_start, path, round(count(*) / CAST(300 AS DOUBLE), 6) AS per_second
      FROM req GROUP BY 1, 2) SELECT {_AT}, path, per_second FROM w""",
)
def throughput(spark, sf_dir):
    return r6(stamp(T.throughput(requests(spark, sf_dir)), "window_start"), "per_second")


@query(
    "latency_quantiles",
    f"""WITH {REQ}, w AS (SELECT {_FIVE} AS window_start, round(quantile_cont(latency_ms, 0.5), 6) AS p50,
      round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99
      FROM req GROUP BY 1) SELECT {_AT}, p50, p95, p99 FROM w""",
)
def latency_quantiles(spark, sf_dir):
    found = T.latency_quantiles(requests(spark, sf_dir))
    return r6(stamp(found, "window_start"), "p50", "p95", "p99")


ERRORS = f"""{REQ}, errs AS (SELECT {_FIVE} AS window_start,
    (count(*) FILTER (WHERE status >= 500) / CAST(300 AS DOUBLE))
      / greatest(count(*) / CAST(300 AS DOUBLE), 0.001) AS error_rate FROM req GROUP BY 1)"""


@query("error_rate", f"WITH {ERRORS} SELECT {_AT}, round(error_rate, 6) AS error_rate FROM errs")
def error_rate(spark, sf_dir):
    return r6(stamp(T.error_rate(requests(spark, sf_dir)), "window_start"), "error_rate")


@query(
    "held_error_alerts",
    f"""WITH {ERRORS}, hot AS (SELECT window_start FROM errs WHERE error_rate > 0.01),
      g AS (SELECT window_start, CASE WHEN epoch(window_start) - epoch(lag(window_start) OVER (ORDER BY window_start)) <= 300
        THEN 0 ELSE 1 END AS fresh FROM hot),
      s AS (SELECT window_start, sum(fresh) OVER (ORDER BY window_start) AS spell FROM g),
      e AS (SELECT min(window_start) AS a, max(window_start) AS b FROM s GROUP BY spell)
    SELECT strftime(a, '%Y-%m-%d %H:%M:%S') AS started_at, strftime(a + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS fired_at,
      strftime(b, '%Y-%m-%d %H:%M:%S') AS ended_at FROM e WHERE epoch(b) - epoch(a) >= 600""",
)
def held_error_alerts(spark, sf_dir):
    """Error rate above 1 % for ten minutes on end."""
    series = T.error_rate(requests(spark, sf_dir))
    found = T.hold_alert(series, F.col("error_rate") > 0.01, hold_seconds=600, step_seconds=300)
    return stamp(found, "started_at", "fired_at", "ended_at")


@query(
    "report_staleness",
    f"""WITH {REQ} SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest,
      CAST(floor(epoch(TIMESTAMP '2024-02-01')) - floor(epoch(max(ts))) AS BIGINT) AS age_seconds,
      FALSE AS missing, floor(epoch(TIMESTAMP '2024-02-01')) - floor(epoch(max(ts))) > 86400 AS stale FROM req""",
)
def report_staleness(spark, sf_dir):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return stamp(T.staleness(requests(spark, sf_dir), now, ts="ts"), "latest")


@query(
    "counter_delta",
    f"""WITH {REQ}, a AS (SELECT path, status, caller, count(*) AS v FROM req GROUP BY 1, 2, 3),
      b AS (SELECT path, status, caller, count(*) AS v FROM req WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1, 2, 3)
    SELECT path, status, caller, a.v - coalesce(b.v, 0) AS delta FROM a LEFT JOIN b USING (path, status, caller)""",
)
def counter_delta(spark, sf_dir):
    """Request counters per series at two scrape times."""
    keys = ["path", "status", "caller"]

    def scrape(df):
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("value"))

    all_rows = requests(spark, sf_dir)
    before = all_rows.where(F.col("ts") < F.lit("2024-01-10").cast("timestamp"))
    return T.counter_delta(scrape(before), scrape(all_rows), keys)


@query(
    "counter_increase",
    f"""WITH {REQ}, d AS (SELECT path, date_trunc('day', ts) AS day, count(*) AS n FROM req GROUP BY 1, 2)
    SELECT path, strftime(day, '%Y-%m-%d %H:%M:%S') AS ts, n AS delta FROM d""",
)
def counter_increase(spark, sf_dir):
    """Daily scrapes of a growing counter, and back to the growth per day."""
    daily = requests(spark, sf_dir).groupBy("path", F.date_trunc("day", "ts").alias("ts")).agg(
        F.count(F.lit(1)).alias("n")
    )
    so_far = Window.partitionBy("path").orderBy("ts")
    scrapes = daily.select("path", "ts", F.sum("n").over(so_far).alias("value"))
    return stamp(T.counter_increase(scrapes, ["path"]), "ts")


RESTARTED = f"""{REQ}, s AS (SELECT path, caller % 5 AS server, date_trunc('minute', ts) AS ts, max(request_id) AS any_id, count(*) AS n
      FROM req GROUP BY 1, 2, 3),
    lives AS (SELECT *, CAST(floor(epoch(ts) / 400000) AS BIGINT) AS life FROM s),
    scrapes AS (SELECT path, server, ts, CAST(sum(n) OVER (PARTITION BY path, server, life ORDER BY ts) AS BIGINT) AS value, any_id FROM lives)"""


def restarted_scrapes(spark, sf_dir):
    """A request counter per path and server, scraped at its busy minutes; servers restart every 400,000 s.

    Every seventh scrape is missing.
    """
    minutes = requests(spark, sf_dir).groupBy(
        "path", (F.col("caller") % 5).alias("server"), F.date_trunc("minute", "ts").alias("ts")
    ).agg(F.max("request_id").alias("any_id"), F.count(F.lit(1)).alias("n"))
    life = Window.partitionBy("path", "server", F.floor(F.unix_timestamp("ts") / 400_000)).orderBy("ts")
    return minutes.select("path", "server", "ts", F.sum("n").over(life).alias("value"), "any_id").where("any_id % 7 <> 0")


@query(
    "counter_rates",
    f"""WITH {RESTARTED}, g AS (SELECT path, server, ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
        CASE WHEN lag(value) OVER w IS NULL THEN 0 WHEN value < lag(value) OVER w THEN value ELSE value - lag(value) OVER w END AS growth
      FROM scrapes WHERE any_id % 7 <> 0 WINDOW w AS (PARTITION BY path, server ORDER BY ts)),
    t AS (SELECT *, sum(growth) OVER (PARTITION BY path, server ORDER BY sec) AS total FROM g),
    r AS (SELECT *, first_value(total) OVER w AS before, first_value(sec) OVER w AS since, count(*) OVER w AS scrapes FROM t
      WINDOW w AS (PARTITION BY path, server ORDER BY sec RANGE BETWEEN 14399 PRECEDING AND CURRENT ROW))
    SELECT path, server, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(total AS BIGINT) AS total,
      CAST(total - before AS BIGINT) AS increase, round((total - before) / CAST(nullif(sec - since, 0) AS DOUBLE), 9) AS per_second, scrapes FROM r""",
)
def counter_rates(spark, sf_dir):
    """Growth and rate over four hours at every scrape, over restarts and missing scrapes."""
    found = T.counter_rates(restarted_scrapes(spark, sf_dir), ["path", "server"], 14_400)
    return stamp(found, "ts").withColumn("per_second", F.round("per_second", 9))


@query(
    "counter_increase_with_restarts",
    f"""WITH {RESTARTED}, d AS (SELECT path, server, ts, value, lag(value) OVER (PARTITION BY path, server ORDER BY ts) AS before
      FROM scrapes WHERE any_id % 7 <> 0)
    SELECT path, server, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
      CAST(CASE WHEN before IS NULL OR value < before THEN value ELSE value - before END AS BIGINT) AS delta FROM d""",
)
def counter_increase_with_restarts(spark, sf_dir):
    return stamp(T.counter_increase(restarted_scrapes(spark, sf_dir), ["path", "server"]), "ts")


PROBS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def rolled_up_sql(where: str = "TRUE") -> str:
    return f"""SELECT level, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, path, count(*) AS rows, round(min(latency_ms), 6) AS low,
      round(max(latency_ms), 6) AS high, TRUE AS p50_near, TRUE AS p95_near, TRUE AS p99_near
    FROM (SELECT 'hour' AS level, date_trunc('hour', ts) AS w, * FROM req WHERE {where}
      UNION ALL SELECT 'day', date_trunc('day', ts), * FROM req WHERE {where}) GROUP BY 1, 2, 3"""


def rolled_up(log, kept):
    """Hours and days from kept five-minute sketches, and whether each quantile's rank lies within the bound.

    A rank can only be met up to half a row, whatever the sketch.
    """
    out = []
    for level, length in (("hour", "1 hour"), ("day", "1 day")):
        rolled = K.sketch_quantiles(K.roll_up(kept, length, ["path"]), PROBS)
        errors = K.rank_errors(log, rolled, "latency_ms", PROBS, length, by=["path"])
        near = [(F.col(f"{p}_error") <= K.RANK_ERROR + 0.5 / F.col("rows")).alias(f"{p}_near") for p in PROBS]
        joined = errors.join(rolled.select("window_start", "path", "n", "low", "high"), ["window_start", "path"])
        out.append(joined.select(F.lit(level).alias("level"), "window_start", "path", F.col("n").alias("rows"), "low", "high", *near))
    return r6(stamp(out[0].unionByName(out[1]), "window_start"), "low", "high")


@query("latency_quantiles_rolled_up", f"WITH {REQ} {rolled_up_sql()}")
def latency_quantiles_rolled_up(spark, sf_dir):
    """Latency quantiles of hours and days per path from five-minute sketches, without the log."""
    log = requests(spark, sf_dir)
    return rolled_up(log, materialize(K.sketch_windows(log, "latency_ms", by=["path"]), "sketches"))


STAGES = ["click", "purchase", "signup", "view"]


@query(
    "stage_breakdown",
    f"""WITH {REQ}, s AS (SELECT path AS stage, CASE caller % 3 WHEN 0 THEN 1 WHEN 1 THEN 8 ELSE 32 END AS rows,
        latency_ms / 1000 AS seconds FROM req),
      o AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY rows, stage) AS n FROM s
        WINDOW w AS (PARTITION BY rows, stage ORDER BY seconds)),
      g AS (SELECT rows, stage, min(seconds) FILTER (WHERE i = CAST(round_even(0.5 * (n - 1), 0) AS BIGINT)) AS p50,
        min(seconds) FILTER (WHERE i = CAST(round_even(CAST(0.95 AS DOUBLE) * (n - 1), 0) AS BIGINT)) AS p95, avg(seconds) AS mean FROM o GROUP BY 1, 2)
    SELECT rows, stage, round(p50, 6) AS p50, round(p95, 6) AS p95, round(mean, 6) AS mean,
      round(CASE WHEN stage <> 'error' THEN mean / sum(mean) FILTER (WHERE stage <> 'error') OVER (PARTITION BY rows) END, 6) AS share FROM g""",
)
def stage_breakdown(spark, sf_dir):
    """Event types as stages, callers as batch sizes."""
    caller = F.col("caller") % 3
    size = F.when(caller == 0, 1).when(caller == 1, 8).otherwise(32)
    samples = requests(spark, sf_dir).select(
        F.col("path").alias("stage"), size.alias("rows"), (F.col("latency_ms") / 1000).alias("seconds")
    )
    return r6(T.stage_breakdown(samples, STAGES), "p50", "p95", "mean", "share")


@query(
    "endpoint_table",
    f"""WITH {RUNS} SELECT run, endpoint, requests, failures, round(rps, 6) AS rps, round(p50_ms, 6) AS p50_ms,
      round(p95_ms, 6) AS p95_ms, round(p99_ms, 6) AS p99_ms, round(error_rate, 6) AS error_rate FROM stats""",
)
def endpoint_table(spark, sf_dir):
    found = T.endpoint_table(runs(spark, sf_dir), by=["run"])
    return r6(found, "rps", "p50_ms", "p95_ms", "p99_ms", "error_rate")


ONE = f"""{RUNS}, one AS (SELECT v.run, v.p50_ms, v.p95_ms, v.p99_ms, a.rps, a.error_rate
    FROM stats v JOIN stats a USING (run) WHERE v.endpoint = 'view' AND a.endpoint = 'Aggregated')"""


@query(
    "slo_report",
    f"""WITH {ONE}, c AS (
      SELECT run, 'p50 latency' AS slo, p50_ms AS measured, 50.0 AS target, p50_ms <= 50 AS ok FROM one
      UNION ALL SELECT run, 'p95 latency', p95_ms, 200.0, p95_ms <= 200 FROM one
      UNION ALL SELECT run, 'error rate', error_rate, 0.01, error_rate <= 0.01 FROM one
      UNION ALL SELECT run, 'availability', 1 - error_rate, 0.99, 1 - error_rate >= 0.99 FROM one)
    SELECT run, slo, round(measured, 6) AS measured, CAST(target AS DOUBLE) AS target,
      CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS result FROM c""",
)
def slo_report(spark, sf_dir):
    stats = T.endpoint_table(runs(spark, sf_dir), by=["run"])
    return r6(T.slo_report(stats, "view"), "measured")


@query(
    "run_comparison",
    f"""WITH {ONE} SELECT run, round(p50_ms, 6) AS p50_ms, round(p95_ms, 6) AS p95_ms, round(p99_ms, 6) AS p99_ms,
      round(rps, 6) AS rps, round(error_rate, 6) AS error_rate, CASE WHEN p50_ms <= 50 THEN 'PASS' ELSE 'FAIL' END AS p50_result,
      CASE WHEN p95_ms <= 200 THEN 'PASS' ELSE 'FAIL' END AS p95_result FROM one ORDER BY run""",
)
def run_comparison(spark, sf_dir):
    stats = T.endpoint_table(runs(spark, sf_dir), by=["run"])
    return r6(T.run_comparison(stats, "view"), "p50_ms", "p95_ms", "p99_ms", "rps", "error_rate")


@query(
    "batch_size_distribution",
    f"""WITH {REQ}, c AS (SELECT caller, date_trunc('day', ts) AS d, count(*) AS rows FROM req GROUP BY 1, 2),
      le AS (SELECT unnest([1::DOUBLE, 2, 4, 8, 16, 32, 64, 128, 1000, 'Infinity'::DOUBLE]) AS le)
    SELECT CASE WHEN isinf(le) THEN 'inf' ELSE CAST(CAST(le AS BIGINT) AS VARCHAR) END AS le,
      count(*) FILTER (WHERE rows <= le) AS n, count(*) AS calls, round(avg(rows), 6) AS mean_rows FROM c, le GROUP BY le""",
)
def batch_size_distribution(spark, sf_dir):
    """One call per caller and day."""
    found = T.batch_size_distribution(
        requests(spark, sf_dir), ["caller", F.date_trunc("day", "ts").alias("d")]
    )
    bound = F.when(F.col("le") == float("inf"), "inf").otherwise(
        F.col("le").cast("long").cast("string")
    )
    return r6(found.withColumn("le", bound), "mean_rows")
