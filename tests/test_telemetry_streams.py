import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskspark.operators import telemetry as T
from riskspark.plans.training import Scorer, prepare, scorer
from riskspark.operators.models import fit_logistic
from riskspark.schema import Split
from riskspark.sources.readers import parse_scrape, read_request_stream, read_stats
from riskspark.sources.synth import synthetic_appointments
from riskspark.streaming.scoring import Champion, score_stream, score_table
from riskspark.streaming.telemetry import alerts_per_window_stream, append_to_table

START = datetime(2024, 1, 1)
INF = float("inf")


def buckets(spark, counts):
    return spark.createDataFrame([("s", le, n) for le, n in counts], "s string, le double, n long")


@pytest.mark.parametrize(
    "counts, q, wanted",
    [
        ([(1.0, 2), (2.0, 6), (INF, 8)], 0.5, 1.5),
        ([(1.0, 2), (2.0, 6), (INF, 8)], 0.25, 1.0),
        ([(1.0, 2), (2.0, 6), (INF, 8)], 0.99, 2.0),
        ([(1.0, 0), (2.0, 0), (INF, 4)], 0.5, 2.0),
        ([(1.0, 4), (INF, 4)], 0.0, 0.0),
        ([(1.0, 0), (INF, 0)], 0.5, math.nan),
        ([(1.0, 3)], 0.5, math.nan),
    ],
)
def test_histogram_quantile(spark, counts, q, wanted):
    found = T.histogram_quantile(buckets(spark, counts), {"q": q}, ["s"]).first()["q"]
    assert found == wanted or (math.isnan(wanted) and math.isnan(found))


@pytest.mark.parametrize("bucket", [60, 180, 86_400])
def test_hold_alert(spark, bucket):
    flags = [1, 1, 1, 0, 1, 1, None, 1, 1, 1, 1]
    rows = [(START + timedelta(minutes=i), bool(f)) for i, f in enumerate(flags) if f is not None]
    series = spark.createDataFrame(rows, "window_start timestamp, bad boolean")
    found = T.hold_alert(series, F.col("bad"), 120, 60, bucket_seconds=bucket).orderBy("started_at").collect()
    minutes = [tuple(int((t - START).total_seconds() // 60) for t in r) for r in found]
    assert minutes == [(0, 2, 2), (7, 9, 10)]


def test_staleness(spark):
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    reports = spark.createDataFrame([(START,)], "generated_at timestamp")
    row = T.staleness(reports, now).first()
    assert row["age_seconds"] == 172800 and row["stale"] and not row["missing"]
    gone = T.staleness(reports.where("false"), now).first()
    assert gone["missing"] and not gone["stale"]


def test_counters(spark):
    schema = "path string, le string, value long"
    before = spark.createDataFrame([("a", None, 3)], schema)
    after = spark.createDataFrame([("a", None, 5), ("b", "1", 4)], schema)
    found = {r["path"]: r["delta"] for r in T.counter_delta(before, after, ["path", "le"]).collect()}
    assert found == {"a": 2, "b": 4}


def test_stage_breakdown_uses_nearest_rank(spark):
    rows = [("model", 1, float(v)) for v in (1, 2, 3, 4)] + [("total", 1, 20.0), ("encode", 1, 7.5)]
    df = spark.createDataFrame(rows, "stage string, rows int, seconds double")
    found = {r["stage"]: r for r in T.stage_breakdown(df, ["model", "encode"]).collect()}
    assert (found["model"]["p50"], found["model"]["p95"]) == (3.0, 4.0)  # ranks round(1.5), round(2.85)
    assert found["model"]["share"] == pytest.approx(0.25) and found["total"]["share"] is None


def test_load_test_files(spark, tmp_path):
    head = "Type,Name,Request Count,Failure Count,Requests/s,50%,95%,99%\n"
    for run, p50 in (("fast", 45), ("slow", 75)):
        (tmp_path / f"{run}_stats.csv").write_text(
            head + f"POST,/predict,100,1,10.5,{p50},80,120\nGET,/health,0,0,0.0,N/A,N/A,N/A\n,Aggregated,100,1,10.5,40,80,120\n"
        )
    stats = read_stats(spark, [str(tmp_path / f"{r}_stats.csv") for r in ("fast", "slow")])
    assert {r["endpoint"] for r in stats.collect()} == {"POST /predict", "GET /health", "Aggregated"}
    health = stats.where("endpoint = 'GET /health'").first()
    assert health["p50_ms"] is None and health["error_rate"] == 0.0
    report = {(r["run"], r["slo"]): r["result"] for r in T.slo_report(stats, "POST /predict").collect()}
    assert report[("fast", "p50 latency")] == "PASS" and report[("slow", "p50 latency")] == "FAIL"
    assert report[("fast", "error rate")] == report[("fast", "availability")] == "PASS"
    assert [r["p50_result"] for r in T.run_comparison(stats, "POST /predict").collect()] == ["PASS", "FAIL"]


def test_scrape_lines(spark):
    lines = [
        "# HELP latency help",
        'latency_bucket{path="/a \\"x\\"",le="0.1"} 3',
        'latency_bucket{path="/a",le="+Inf"} 5.0',
        "up 1",
        "",
    ]
    found = parse_scrape(spark.createDataFrame([(line,) for line in lines], "value string")).collect()
    assert [(r["name"], r["le"], r["value"]) for r in found] == [
        ("latency_bucket", 0.1, 3.0), ("latency_bucket", INF, 5.0), ("up", None, 1.0),
    ]
    assert found[1]["labels"] == {"path": "/a"} and found[2]["labels"] == {}


def test_window_stream_equals_batch_on_closed_windows(spark, tmp_path):
    """Three micro-batches in time order, then a late row that the watermark drops."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    checkpoint = str(tmp_path / "checkpoint")
    schema = "ts timestamp, alert boolean"

    def land(minutes):
        rows = [(START + timedelta(minutes=m), m % 3 == 0) for m in minutes]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = read_request_stream(spark, source, spark.createDataFrame([], schema).schema)
        append_to_table(alerts_per_window_stream(stream), out, checkpoint).awaitTermination()

    everything = []
    for minutes in (range(0, 60, 7), range(60, 140, 7), range(140, 300, 7)):
        land(minutes)
        everything += list(minutes)
    land([1])
    rows = [(START + timedelta(minutes=m), m % 3 == 0) for m in everything]
    closed = START + timedelta(minutes=max(everything) - 10 - 60)
    batch = T.alerts_per_window(spark.createDataFrame(rows, schema)).where(F.col("window_start") <= F.lit(closed))
    found = spark.read.parquet(out)
    assert found.count() == batch.count() > 20
    assert found.exceptAll(batch).count() == 0


@pytest.fixture(scope="module")
def one_scorer(spark):
    raw = synthetic_appointments(spark.range(1200), "id")
    prepared, builder, preprocessor = prepare(raw, Split("2016-04-15", "2016-05-10"))
    model = fit_logistic(prepared.where("split = 'train'"))
    return raw, scorer(builder, preprocessor, model, 0.5, "1")


def test_scoring_stream_swaps_versions_and_survives_a_bad_one(spark, tmp_path, one_scorer):
    raw, first = one_scorer
    requests = raw.drop("no_show").withColumnRenamed("appointment_id", "request_id").where("request_id < 90")
    requests = requests.withColumn("age", F.when(F.col("request_id") % 10 == 0, 300).otherwise(F.col("age")))
    path = [str(tmp_path / n) for n in ("inbox", "predictions", "quarantine", "checkpoint")]
    alias = {"rows": [("risk", "champion", "1", 0.5, "2024-01-01")]}
    schema = "name string, alias string, version string, threshold double, ts string"

    def load(version, threshold):
        if version == "broken":
            raise OSError("no such version")
        return Scorer(first.features, first.model, threshold, version)

    champion = Champion(lambda: spark.createDataFrame(alias["rows"], schema), load, "risk")

    def arrive(low, high):
        part = requests.where((F.col("request_id") >= low) & (F.col("request_id") < high))
        part.write.mode("append").parquet(path[0])
        stream = read_request_stream(spark, path[0], requests.schema)
        score_stream(stream, champion, path[1], path[2], path[3]).awaitTermination()

    arrive(0, 30)
    alias["rows"].append(("risk", "champion", "broken", 0.5, "2024-01-02"))
    arrive(30, 60)
    assert "no such version" in champion.last_error
    alias["rows"].append(("risk", "champion", "3", 0.5, "2024-01-03"))
    arrive(60, 90)
    assert champion.last_error is None
    found = spark.read.parquet(path[1])
    versions = {r["model_version"]: r["count"] for r in found.groupBy("model_version").count().collect()}
    assert versions == {"1": 54, "3": 27}
    bad = spark.read.parquet(path[2])
    assert bad.count() == 9 and {r["reasons"][0]["column"] for r in bad.collect()} == {"age"}
    batch, _ = score_table(requests, first)
    both = found.drop("batch", "model_version")
    assert both.exceptAll(batch.drop("model_version")).count() == 0


def test_no_champion_stops_the_first_batch(spark):
    log = spark.createDataFrame([], "name string, alias string, version string, threshold double, ts string")
    with pytest.raises(LookupError):
        Champion(lambda: log, lambda v, t: None, "risk").current()
