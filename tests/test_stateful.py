import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskspark.operators.history import asof_history, fit_history
from riskspark.operators.telemetry import hold_alert
from riskspark.plans.queries.streams import arriving
from riskspark.streaming.history import history_stream
from riskspark.streaming.stateful import held_alerts_stream, spells, watchdog_stream

START = datetime(2024, 1, 1)


def minute(n):
    return START + timedelta(minutes=n)


def test_held_alerts_equal_the_batch_form_in_any_order_of_arrival(spark):
    rng = random.Random(4)
    rows = []
    for name in ("a", "b", "c"):
        for n in range(120):
            if rng.random() < 0.93:  # some steps are missing
                rows.append((name, minute(n), rng.random() < 0.8))
    schema = "name string, window_start timestamp, bad boolean"
    series = spark.createDataFrame(rows, schema)
    wanted = hold_alert(series, F.col("bad"), 180, 60, by=["name"]).collect()
    # Rows come up to ten minutes late, the last says only what time it is.
    rng.shuffle(rows)
    rows.sort(key=lambda r: int((r[1] - START).total_seconds()) // 600)
    cut = [rows[: len(rows) // 2], rows[len(rows) // 2 :], [("now", minute(500), None)]]
    slices = [spark.createDataFrame(part, schema) for part in cut]
    states = arriving(
        spark,
        {"series": slices},
        lambda series: held_alerts_stream(series, F.col("bad"), 180, 60, ["name"], late="20 minutes"),
        "held-test",
    )
    found = spells(states, ["name"], "firing", "resolved")
    assert sorted(map(tuple, found.select("name", "since", "began", "ended").collect())) == sorted(map(tuple, wanted))
    assert len(wanted) > 5
    kinds = {r["state"]: r["n"] for r in states.groupBy("state").agg(F.count("*").alias("n")).collect()}
    assert kinds["firing"] == kinds["resolved"] == len(wanted)
    assert kinds["pending"] == kinds["resolved"] + kinds["dropped"]


def test_an_alert_fires_and_resolves_without_further_rows_of_its_own(spark):
    schema = "name string, window_start timestamp, bad boolean"
    first = spark.createDataFrame([("a", minute(n), True) for n in range(3)], schema)
    stream = lambda series: held_alerts_stream(series, F.col("bad"), 120, 60, ["name"])
    later = spark.createDataFrame([("now", minute(10), None)], schema)
    got = arriving(spark, {"series": [first, later]}, stream, "alone").collect()
    assert sorted((r["state"], r["at"]) for r in got) == [("firing", minute(2)), ("pending", minute(0)), ("resolved", minute(2))]


@pytest.mark.parametrize("late", ["0 seconds", "30 minutes"])
def test_watchdog(spark, late):
    rng = random.Random(7)
    rows = [(name, minute(t)) for name in "ab" for t in sorted(rng.sample(range(400), 40))] + [("once", minute(5))]
    order = sorted(rows, key=lambda r: r[1])
    schema = "name string, generated_at timestamp"
    cut = [order[:30], order[30:31], order[31:], [("now", minute(1000))]]
    slices = [spark.createDataFrame(part, schema) for part in cut]
    states = arriving(
        spark,
        {"reports": slices},
        lambda reports: watchdog_stream(reports, 900, ["name"], late=late, tick=F.col("name") == "now"),
        "watchdog-test",
    )
    wanted = []
    for name in ("a", "b", "once"):
        times = [t for n, t in order if n == name]
        for t, after in zip(times, [*times[1:], None]):
            if after is None or after - t > timedelta(minutes=15):
                wanted.append((name, t, t + timedelta(minutes=15), after))
    found = spells(states, ["name"], "silent", "back").collect()
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def visits(rng, n):
    rows = []
    for i in range(n):
        known = rng.randrange(60)
        rows.append((float(rng.choice([1, 2, 3])) if i % 3 else 9.0, i, minute(known * 1440 + 600), minute((known + rng.randrange(20)) * 1440), i % 2))
    return rows


SCHEMA = "patient_id double, appointment_id long, scheduled_day timestamp, appointment_day timestamp, target int"


def test_growing_history_equals_the_batch_form(spark):
    rows = visits(random.Random(2), 300)
    rows += [(None, 900, minute(0), minute(0), 1), (1.0, 901, None, minute(0), 1), (1.0, 902, minute(0), None, 1), (1.0, 903, minute(90 * 1440), minute(0), None)]
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = {r["appointment_id"]: tuple(r)[-2:] for r in asof_history(df, fit_history(df)).collect()}
    cuts = [0, 20, 21, 45, 200]

    def rounds(at):
        days = F.datediff(F.col(at), F.lit(START))
        every = F.coalesce(days, F.lit(0))
        return [df.where((every >= a) & (every < b)) for a, b in zip(cuts, cuts[1:])]

    found = arriving(
        spark,
        {"outcomes": rounds("appointment_day"), "requests": rounds("scheduled_day")},
        lambda outcomes, requests: history_stream(outcomes, requests.drop("target")),
        "history-test",
    )
    got = {r["appointment_id"]: (r["previous_appointments"], r["previous_miss_rate"]) for r in found.collect()}
    assert got == wanted and len(got) == len(rows)
    # Times come back as they went in.
    times = {r["appointment_id"]: r["scheduled_day"] for r in found.collect()}
    assert times == {r[1]: r[2] for r in rows}


def test_idle_entities_are_forgotten_when_asked_for(spark):
    outcome = lambda p, d: (p, d, minute(d * 1440), minute(d * 1440), 1)
    slices = [[outcome(1.0, 0), outcome(2.0, 0)], [outcome(2.0, 30)], [outcome(3.0, 60)], [outcome(1.0, 61), outcome(2.0, 61)]]
    frames = [spark.createDataFrame(s, SCHEMA) for s in slices]
    none = frames[0].where("false")
    stream = lambda days: lambda outcomes, requests: history_stream(outcomes, requests, forget_days=days)
    for days, wanted in ((None, {1.0: 1.0, 2.0: 2.0}), (40, {1.0: 0.0, 2.0: 2.0})):
        tables = {"outcomes": [*frames[:3], none], "requests": [none, none, none, frames[3]]}
        found = arriving(spark, tables, stream(days), "forget").collect()
        assert {r["patient_id"]: r["previous_appointments"] for r in found} == wanted
