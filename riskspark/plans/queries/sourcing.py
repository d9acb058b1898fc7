"""Reading and writing."""

from pyspark.sql import functions as F

from riskspark.functions import parse_time
from riskspark.operators.metrics import METRICS, classification_metrics
from riskspark.operators.telemetry import endpoint_table, score_histogram
from riskspark.plans.adapter import appointments, requests, table
from riskspark.plans.queries.base import CLEAN, REQ, SCORES, APPT, curve_sql, experiment_scores, query, r6, rows, stamp
from riskspark.schema import RAW_NAMES
from riskspark.session import configure, shared_dir
from riskspark.sources.readers import (
    file_digest,
    ingest,
    read_raw,
    read_results,
    read_scrape,
    read_stats,
    table_fingerprint,
)
from riskspark.sources.writers import write_drift_sets, write_splits


def raw_text(df):
    """Appointments under their raw names, times as ISO text."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    renamed = df.withColumns(
        {c: F.date_format(c, iso) for c in ("scheduled_day", "appointment_day")}
    )
    return renamed.select([F.col(v).alias(k) for k, v in RAW_NAMES.items()])


@query(
    "read_raw_table",
    f"""WITH {APPT} SELECT patient_id, appointment_id, gender,
      strftime(scheduled_day, '%Y-%m-%d') AS scheduled,
      strftime(appointment_day, '%Y-%m-%d') AS appointment,
      age, neighbourhood, sms_received, handcap, no_show FROM appt""",
)
def read_raw_table(spark, sf_dir):
    path = shared_dir(configure(spark), "raw")
    raw_text(appointments(spark, sf_dir)).write.option("header", True).csv(path)
    typed = ingest(read_raw(spark, path))

    def text(name):
        return F.date_format(parse_time(F.col(name)), "yyyy-MM-dd")

    return typed.select(
        "patient_id", "appointment_id", "gender",
        text("scheduled_day").alias("scheduled"), text("appointment_day").alias("appointment"),
        "age", "neighbourhood", "sms_received", "handcap", "no_show",
    )


@query("file_digests")
def file_digests(spark, sf_dir):
    names = ["orders", "customer", "nation", "events"]
    files = file_digest(configure(spark), [f"{sf_dir}/{n}.parquet" for n in names])
    return files.select(F.element_at(F.split("file", "/"), -1).alias("file"), "sha256")


@query("fingerprint_of_tables")
def fingerprint_of_tables(spark, sf_dir):
    parts = [
        table_fingerprint(table(spark, sf_dir, n)).withColumn("name", F.lit(n))
        for n in ("orders", "customer", "events")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "experiment_results",
    f"""WITH {SCORES}, vs AS (SELECT * FROM scores WHERE split = 'val'),
    {curve_sql('vs', 'experiment')}, m AS (
      SELECT experiment, sum(pos * tp / CAST(alerts AS DOUBLE)) / max(all_pos) AS val_pr_auc,
        sum(CASE WHEN score >= 0.5 THEN pos ELSE 0 END) / CAST(max(all_pos) AS DOUBLE) AS val_recall,
        sum(CASE WHEN score >= 0.5 THEN pos ELSE 0 END)
          / CAST(sum(CASE WHEN score >= 0.5 THEN n ELSE 0 END) AS DOUBLE) AS val_precision,
        CAST(0.5 AS DOUBLE) AS val_threshold FROM cur GROUP BY 1)
    SELECT experiment, metric, round(value, 6) AS value FROM (
      UNPIVOT m ON val_pr_auc, val_recall, val_precision, val_threshold
      INTO NAME metric VALUE value)""",
)
def experiment_results(spark, sf_dir):
    """Metrics of three scores, written as one results document and read back."""
    val = experiment_scores(spark, sf_dir).where("split = 'val'")
    wide = classification_metrics(val, "target", "score", 0.5, ["experiment"])
    metrics = F.create_map(*[x for m in METRICS for x in (F.lit(f"val_{m}"), F.col(m))])
    document = wide.agg(
        F.map_from_entries(F.collect_list(F.struct("experiment", metrics.alias("m")))).alias(
            "experiments"
        )
    ).select(
        F.lit("first").alias("selected_model"),
        F.lit(0.5).alias("selected_threshold"),
        F.lit("version").alias("data_sha256"),
        "experiments",
    )
    path = shared_dir(spark, "results")
    document.write.json(path)
    return r6(read_results(spark, path), "value").select("experiment", "metric", "value")


@query(
    "split_tables",
    f"""WITH {CLEAN} SELECT split, count(*) AS n, CAST(sum(target) AS BIGINT) AS positives
    FROM cleaned GROUP BY 1""",
)
def split_tables(spark, sf_dir):
    path = shared_dir(configure(spark), "splits")
    write_splits(rows(spark, sf_dir, place=True), path)
    parts = spark.read.parquet(path)
    return parts.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("target").alias("positives")
    )


@query(
    "drift_sets",
    f"""WITH {CLEAN}, sets AS (
      SELECT 'reference' AS "set", age, sms_received, no_show FROM cleaned WHERE split = 'train'
      UNION ALL SELECT 'data_drift', CASE WHEN age + 20 > 115 THEN 115 ELSE age + 20 END, 1, no_show
        FROM cleaned WHERE split = 'test'
      UNION ALL SELECT 'concept_drift', age, sms_received,
        CASE WHEN sms_received = 1 THEN 'Yes' ELSE no_show END FROM cleaned WHERE split = 'test')
    SELECT "set", count(*) AS n, CAST(sum(age) AS BIGINT) AS ages,
      CAST(sum(sms_received) AS BIGINT) AS sms,
      count(*) FILTER (WHERE no_show = 'Yes') AS missed FROM sets GROUP BY 1""",
)
def drift_set_tables(spark, sf_dir):
    path = shared_dir(configure(spark), "drift-sets")
    write_drift_sets(rows(spark, sf_dir, place=True), path)
    sets = spark.read.parquet(path)
    return sets.groupBy("set").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("age").alias("ages"),
        F.sum("sms_received").alias("sms"),
        F.count_if(F.col("no_show") == "Yes").alias("missed"),
    )


ENDPOINTS = """ends AS (SELECT run, path AS endpoint, ts, status, latency_ms FROM runs
    UNION ALL SELECT run, 'Aggregated', ts, status, latency_ms FROM runs),
  stats AS (SELECT run, endpoint, count(*) AS requests,
      count(*) FILTER (WHERE status >= 500) AS failures,
      count(*) / (epoch_us(max(ts)) - epoch_us(min(ts))) * 1e6 AS rps,
      quantile_cont(latency_ms, 0.5) AS p50_ms, quantile_cont(latency_ms, 0.95) AS p95_ms,
      quantile_cont(latency_ms, 0.99) AS p99_ms,
      count(*) FILTER (WHERE status >= 500) / CAST(count(*) AS DOUBLE) AS error_rate
    FROM ends GROUP BY 1, 2)"""

RUNS = f"""{REQ}, runs AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'early'
    ELSE 'late' END AS run FROM req), {ENDPOINTS}"""


def runs(spark, sf_dir):
    """The request log as two runs, before and from the middle of the month."""
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    return requests(spark, sf_dir).withColumn("run", F.when(early, "early").otherwise("late"))


@query(
    "load_test_statistics",
    f"""WITH {RUNS} SELECT run, endpoint, requests, failures, round(rps, 6) AS rps,
      round(p50_ms, 6) AS p50_ms, round(p95_ms, 6) AS p95_ms, round(p99_ms, 6) AS p99_ms,
      round(error_rate, 6) AS error_rate FROM stats""",
)
def load_test_statistics(spark, sf_dir):
    """Per-run statistics written as load-test CSV files and read back."""
    stats = endpoint_table(runs(spark, sf_dir), by=["run"])
    kind = F.when(F.col("endpoint") != "Aggregated", "")
    base = shared_dir(spark, "stats")
    for run in ("early", "late"):
        stats.where(F.col("run") == run).select(
            kind.alias("Type"),
            F.col("endpoint").alias("Name"),
            F.col("requests").alias("Request Count"),
            F.col("failures").alias("Failure Count"),
            F.col("rps").alias("Requests/s"),
            F.col("p50_ms").alias("50%"),
            F.col("p95_ms").alias("95%"),
            F.col("p99_ms").alias("99%"),
        ).write.option("header", True).csv(f"{base}/{run}_stats.csv")
    found = read_stats(spark, [f"{base}/early_stats.csv", f"{base}/late_stats.csv"])
    return r6(found, "rps", "p50_ms", "p95_ms", "p99_ms", "error_rate")


HOURS = """hist AS (SELECT date_trunc('hour', ts) AS window_start, le,
    count(*) FILTER (WHERE score <= le) AS n
  FROM req, (SELECT unnest([0.1::DOUBLE, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9,
    'Infinity'::DOUBLE]) AS le) GROUP BY 1, 2)"""


@query(
    "metric_scrape",
    f"""WITH {REQ}, {HOURS} SELECT 'score_bucket' AS name,
      strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
      CASE WHEN isinf(le) THEN 'inf' ELSE CAST(le AS VARCHAR) END AS le,
      CAST(n AS DOUBLE) AS value FROM hist""",
)
def metric_scrape(spark, sf_dir):
    """The score histogram written as text metric lines and read back."""
    hist = stamp(score_histogram(requests(spark, sf_dir)), "window_start")
    bound = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    line = F.format_string(
        'score_bucket{window="%s",le="%s"} %d', F.col("window_start"), bound, F.col("n")
    )
    path = shared_dir(spark, "scrape")
    hist.select(line.alias("value")).write.text(path)
    found = read_scrape(spark, path)
    return found.select(
        "name",
        F.col("labels")["window"].alias("window_start"),
        F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("string")).alias("le"),
        "value",
    )


