import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskspark.operators.history import asof_history, fit_history
from riskspark.operators.history_store import HistoryStore
from riskspark.operators.registry import KeyRegistry
from riskspark.sources.readers import read_request_stream
from riskspark.streaming.scoring import Log, score_stream_once
from riskspark.streaming.stateful import keyed_state

START = datetime(2024, 1, 1)
VISITS = "patient_id double, appointment_id long, scheduled_day timestamp, appointment_day timestamp, target int"


def test_deltas_equal_a_full_fit_without_moving_the_history(spark):
    rng = random.Random(3)
    day = lambda n: START + timedelta(days=n)
    rows = [(float(rng.choice([1, 1, 1, 2, 3, 4, 5])), i, day(rng.randrange(80)), day(rng.randrange(80)), i % 2) for i in range(300)]
    rows += [(None, 900, day(3), day(1), 1), (1.0, 901, None, day(1), 1), (1.0, 902, day(40), None, 1), (77.0, 903, day(40), day(2), None)]
    df = spark.createDataFrame(rows, VISITS)
    store = HistoryStore(spark, 4)
    parts = [df.where(F.pmod(F.col("appointment_id"), F.lit(4)) == n) for n in range(4)]
    for part in parts[:2]:
        store.append(part)
    store.compact()
    assert store.deltas == 1
    for part in parts[2:]:
        store.append(part)
    wanted = sorted(map(tuple, fit_history(df).select("entity", "day", "n", "k").collect()))
    assert sorted(map(tuple, store.state().collect())) == wanted
    for table in (store.state(), store.by_part()):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange" not in plan
    found = store.asof(df)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, asof_history(df, fit_history(df)).collect()), key=str)
    # In the whole question only the asked days and the rows move, not the table.
    plan = store.asof(df)._jdf.queryExecution().executedPlan().toString().splitlines()
    (at,) = [i for i, line in enumerate(plan) if f"{store.table}[" in line][:1]
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    above, level = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if depth(line) < level:
            level = depth(line)
            above.append(line)
    below_join = above[: next(i for i, line in enumerate(above) if "Join" in line)]
    assert not any("Exchange" in line for line in below_join)


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_keys_loaded_before(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr("riskspark.operators.registry.FEW", few)
    rng = random.Random(few)
    loads = [[rng.choice([None, *range(3000)]) for _ in range(900)] for _ in range(4)]
    registry, seen = KeyRegistry(spark, str(tmp_path), "k", "bigint"), {}
    for number, keys in enumerate(loads, 1):
        df = spark.createDataFrame([(k, "x") for k in keys], "k bigint, load string")
        got = {(r["k"], r["load"]) for r in registry.repeated(df).collect()}
        assert got == {(k, n) for k in set(keys) - {None} for n in seen.get(k, ())}
        if number == 3:
            for row in registry.false_positives(df).collect():
                old = set(loads[row["load"] - 1])
                assert row["new_keys"] == len(set(keys) - old - {None}) and row["share"] < 0.03
        registry.add(df)
        for k in set(keys) - {None}:
            seen.setdefault(k, []).append(number)
    number = registry.compact()
    again = registry.repeated(spark.createDataFrame([(k,) for k in range(3000)], "k bigint"))
    assert {(r["k"], r["load"]) for r in again.collect()} == {(k, number) for k in seen}
    assert len(registry.loads) == 1


class Fixed:
    """A scorer that only passes ids on."""

    def current(self):
        return self

    def score(self, rows, keep):
        return rows.select(*keep, F.lit(0.5).alias("score"))


REQUESTS = (
    "request_id long, received_at timestamp, patient_id string, gender string, scheduled_day string, appointment_day string, "
    "age string, neighbourhood string, scholarship string, hipertension string, diabetes string, alcoholism string, "
    "handcap string, sms_received string"
)


def request(key, minute, gender="F"):
    at = START + timedelta(minutes=minute)
    return (key, at, "1.0", gender, "2024-01-01", "2024-01-05", "30", "NORD", "0", "0", "0", "0", "0", "1")


def test_repeated_requests_and_batches_change_nothing(spark, tmp_path):
    inbox, log = str(tmp_path / "inbox"), Log(spark, str(tmp_path / "log"))
    fields = spark.createDataFrame([], "request_id long, score double").schema
    ids = lambda kind: sorted((r["request_id"] for r in log.read(kind, fields.__class__(fields.fields[:1])).collect()), key=str)
    assert ids("predictions") == []
    stream = spark.createDataFrame([], REQUESTS).schema

    def run(*rows):
        spark.createDataFrame(list(rows), REQUESTS).coalesce(1).write.mode("append").parquet(inbox)
        with keyed_state(spark):
            requests = read_request_stream(spark, inbox, stream)
            score_stream_once(requests, Fixed(), log, str(tmp_path / "checkpoint")).awaitTermination()

    run(request(1, 0), request(2, 1), request(2, 1), request(3, 2, gender="X"), request(None, 2), request(None, 2))
    run(request(1, 5), request(4, 6), request(3, 6))
    assert ids("predictions") == sorted([1, 2, 4, None, None], key=str) and ids("quarantine") == [3]
    # A batch that comes again was published already.
    rows = spark.createDataFrame([(9, 0.1)], fields)
    log.publish(0, rows, rows)
    # One that fails before it is published is not seen, and then seen once.
    rows.write.parquet(str(tmp_path / "log/predictions/batch=7/attempt=lost"))
    assert 9 not in ids("predictions")
    log.publish(7, rows, rows.limit(0))
    log.publish(7, rows, rows)
    assert ids("predictions").count(9) == 1 and ids("quarantine") == [3]
