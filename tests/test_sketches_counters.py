import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskspark.operators import sketches as K
from riskspark.operators import telemetry as T

START = datetime(2024, 1, 1)


def after(seconds):
    return START + timedelta(seconds=seconds)


def plain_rates(rows, window):
    out, series = {}, {}
    for key, ts, value in sorted(rows, key=lambda r: r[1]):
        if value is not None:
            series.setdefault(key, []).append((ts, value))
    for key, points in series.items():
        total, history, last = 0, [], None
        for ts, value in points:
            total += 0 if last is None else value if value < last else value - last
            last = value
            history.append((ts, total))
            inside = [(t, x) for t, x in history if ts - t < timedelta(seconds=window)]
            gone = (ts - inside[0][0]).total_seconds()
            growth = total - inside[0][1]
            out[key, ts] = (total, growth, growth / gone if gone else None, len(inside))
    return out


@pytest.mark.parametrize("bucket", [300, 1000, 10**6])
def test_rates_over_restarts_gaps_and_bucket_bounds(spark, bucket):
    rng = random.Random(bucket)
    rows = []
    for key in ("a", "b", None):
        value = 0
        for n in range(200):
            value = 0 if rng.random() < 0.05 else value + rng.randrange(9)
            if rng.random() < 0.8:
                rows.append((key, after(15 * n), value if rng.random() < 0.97 else None))
    df = spark.createDataFrame(rows, "k string, ts timestamp, value long").repartition(3)
    found = T.counter_rates(df, ["k"], 300, bucket_seconds=bucket).collect()
    assert {(r["k"], r["ts"]): tuple(r)[2:] for r in found} == plain_rates(rows, 300)
    steps = T.counter_increase(df, ["k"], bucket_seconds=bucket)
    ends = {r["k"]: r["s"] for r in steps.groupBy("k").agg(F.sum("delta").alias("s")).collect()}
    for key in ("a", "b", None):
        points = [(ts, v) for k, ts, v in rows if k == key and v is not None]
        last = plain_rates(rows, 300)[key, max(points)[0]][0]
        assert ends[key] == last + min(points)[1]
    with pytest.raises(ValueError):
        T.counter_rates(df, ["k"], 300, bucket_seconds=299)


def test_a_restart_is_no_negative_growth(spark):
    schema = "k string, value long"
    before = spark.createDataFrame([("a", 10), ("b", 5)], schema)
    later = spark.createDataFrame([("a", 3), ("b", 9)], schema)
    assert {r["k"]: r["delta"] for r in T.counter_delta(before, later, ["k"]).collect()} == {"a": 3, "b": 4}


def test_rolled_up_quantiles_stay_within_the_bound(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else "x", after(rng.randrange(7200)), rng.lognormvariate(3, 1)) for i in range(60_000)]
    rows += [("x", after(10), None), ("x", after(10), float("nan"))]
    log = spark.createDataFrame(rows, "path string, ts timestamp, ms double").repartition(4)
    kept = K.sketch_windows(log, "ms", by=["path"])
    probs = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    for length, by in (("1 hour", ["path"]), ("1 day", ["path"]), ("1 day", [])):
        rolled = K.sketch_quantiles(K.roll_up(kept, length, by), probs)
        errors = K.rank_errors(log, rolled, "ms", probs, length, by=by)
        for row in errors.collect():
            assert all(row[f"{p}_error"] <= K.RANK_ERROR for p in ("p50", "p99"))
            assert row["p0_error"] <= 1 / row["rows"] and row["p100_error"] == 0
    day = K.roll_up(kept, "1 day").first()
    values = [v for _, _, v in rows if v is not None and v == v]
    assert (day["n"], day["low"], day["high"]) == (60_000, min(values), max(values))
