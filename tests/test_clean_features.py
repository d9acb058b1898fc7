import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from riskspark.functions import age_group, clip_upper, normalize_label, resolve_column
from riskspark.operators.clean import clean, entity_overlap, parse_times, time_split, with_target
from riskspark.operators.features import (
    FeatureBuilder,
    FeatureBuilderModel,
    base_features,
    feature_parity,
    monitoring_features,
)
from riskspark.operators.history import asof_history, fit_history, history_of
from riskspark.plans.adapter import SPLIT
from riskspark.plans.queries import QUERIES
from riskspark.schema import Split
from tests.conftest import SF

FACTS = ["previous_appointments", "previous_miss_rate"]


def test_clean_drops_and_clips(appointments):
    df = clean(
        appointments(
            {"age": -1},
            {"age": 0, "handcap": 4},
            {"scheduled_day": "2016-05-03T15:00:00Z"},
            {"scheduled_day": "2016-05-04"},
            {"handcap": None},
        )
    )
    kept = {r["appointment_id"]: r["handcap"] for r in df.collect()}
    assert kept == {2: 1, 3: 0, 5: None}


def test_split_compares_instants(appointments):
    split = Split("2016-05-20", "2016-05-31")
    days = ["2016-05-20", "2016-05-20T10:00:00Z", "2016-05-31", "2016-06-01"]
    df = parse_times(appointments(*[{"appointment_day": d} for d in days]), ["appointment_day"])
    found = [r["split"] for r in time_split(df, split).orderBy("appointment_id").collect()]
    assert found == ["train", "val", "val", "test"]


def test_entity_overlap_counts_entities_once(spark):
    rows = [(1.0, "train"), (1.0, "train"), (1.0, "val"), (2.0, "train"), (2.0, "test"), (None, "val"), (None, "test")]
    df = spark.createDataFrame(rows, "patient_id double, split string")
    assert tuple(entity_overlap(df).first()) == (1, 1, 0)


def test_small_expressions(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (4,)], "h int")
    assert [r[0] for r in df.select(clip_upper(F.col("h"), 1)).collect()] == [None, 0, 1, 1]
    ages = spark.createDataFrame([(a,) for a in (0, 12, 13, 18, 35, 36, 55, 75, 76, None)], "a int")
    assert [r[0] for r in ages.select(age_group(F.col("a"))).collect()] == [
        "child", "child", "teen", "teen", "young_adult", "adult", "adult", "senior", "elderly", None,
    ]
    words = spark.createDataFrame([(w,) for w in (" YES", "t", "0", None)], "w string")
    assert [r[0] for r in words.select(normalize_label(F.col("w"))).collect()] == [1, None, 0, None]
    assert resolve_column(df, ["x", "h"]) == "h" and resolve_column(df, ["x"]) is None


def test_base_features(appointments):
    df = parse_times(
        appointments(
            {"age": 0},
            {"age": 18, "scheduled_day": "2016-05-04", "appointment_day": "2016-05-05"},
            {"age": 80, "scheduled_day": "2016-05-05", "appointment_day": "2016-05-04"},
        ),
        ["scheduled_day", "appointment_day"],
    )
    rows = base_features(df).orderBy("appointment_id").collect()
    assert [r["lead_time_days"] for r in rows] == [2, 1, 0]
    assert [r["appointment_weekday"] for r in rows] == ["Tuesday", "Thursday", "Wednesday"]
    assert [r["age_group"] for r in rows] == ["child", "teen", "elderly"]


THREE = [
    {"patient_id": 1.0, "no_show": "Yes"},
    {"patient_id": 1.0, "scheduled_day": "2016-05-04", "appointment_day": "2016-05-05"},
    {"patient_id": 2.0, "appointment_day": "2016-05-04"},
]


def facts(df):
    return [tuple(r[c] for c in FACTS) for r in df.orderBy("appointment_id").collect()]


def build(appointments, rows, queries=None):
    train = with_target(appointments(*rows))
    model = FeatureBuilder().fit(train)
    return facts(model.transform(train if queries is None else appointments(*queries)))


def test_past_outcomes_count(appointments):
    assert build(appointments, THREE) == [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]


def test_future_outcome_is_not_known(appointments):
    rows = [THREE[0], {**THREE[1], "scheduled_day": "2016-05-02"}, THREE[2]]
    assert build(appointments, rows)[1] == (0.0, 0.0)


def test_same_day_next_day_and_unseen(appointments):
    queries = [
        {"scheduled_day": "2016-05-03T12:00:00Z", "appointment_day": "2016-05-06"},
        {"scheduled_day": "2016-05-04", "appointment_day": "2016-05-06"},
        {"patient_id": 999.0, "scheduled_day": "2016-05-04", "appointment_day": "2016-05-06"},
        {"patient_id": None, "scheduled_day": "2016-05-04", "appointment_day": "2016-05-06"},
    ]
    found = build(appointments, THREE[:1] + [{"patient_id": None, "no_show": "Yes"}], queries)
    assert found == [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0), (0.0, 0.0)]


def test_history_equals_brute_force_with_a_hot_patient(spark):
    rng = random.Random(7)
    start = date(2020, 1, 1)

    def row(i):
        patient = 1.0 if rng.random() < 0.4 else (None if rng.random() < 0.2 else float(rng.randint(2, 30)))
        booked = start + timedelta(days=rng.randint(0, 60))
        return i, patient, booked, booked + timedelta(days=rng.randint(0, 20)), rng.randint(0, 1)

    data = [row(i) for i in range(1500)]
    schema = "appointment_id long, patient_id double, scheduled_day date, appointment_day date, target int"
    df = spark.createDataFrame(data, schema).repartition(5)
    train = data[:900]
    history = fit_history(df.where("appointment_id < 900"))
    assert history.groupBy("entity", "day").count().where("count > 1").count() == 0
    found = {r["appointment_id"]: tuple(r[c] for c in FACTS) for r in asof_history(df, history).collect()}
    assert len(found) == 1500
    for i, patient, booked, _, _ in data:
        past = [t for _, p, _, done, t in train if patient is not None and p == patient and done < booked]
        wanted = (float(len(past)), sum(past) / len(past) if past else 0.0)
        assert found[i] == pytest.approx(wanted)
    batch = df.where("appointment_id % 50 = 0")
    pruned = asof_history(batch, history_of(history, batch))
    assert {r["appointment_id"]: tuple(r[c] for c in FACTS) for r in pruned.collect()} == {
        k: v for k, v in found.items() if k % 50 == 0
    }


def test_builder_round_trip_and_parity(spark, appointments, tmp_path):
    rows = with_target(appointments(*THREE))
    model = FeatureBuilder().fit(rows)
    model.save(str(tmp_path / "builder"))
    loaded = FeatureBuilderModel.load(spark, str(tmp_path / "builder"), prune_history=True)
    a, b = model.transform(rows), loaded.transform(rows)
    assert {r["mismatches"] for r in feature_parity(a, b, "appointment_id", FACTS).collect()} == {0}
    moved = b.withColumn("previous_appointments", F.lit(5.0)).where("appointment_id < 3")
    found = {r["feature"]: r["mismatches"] for r in feature_parity(a, moved, "appointment_id", FACTS).collect()}
    assert found == {"previous_appointments": 3, "previous_miss_rate": 1}


def test_monitoring_features_differ_from_model_features(appointments):
    df = appointments(
        {"scheduled_day": "2016-05-03T12:00:00Z", "age": None, "neighbourhood": None}
    ).withColumnRenamed("handcap", "Handicap")
    row = monitoring_features(df).first()
    assert row["lead_time_days"] == -0.5 and row["appointment_weekday"] == 1.0
    assert row["neighbourhood"] == "<missing>" and row["age"] is None and row["handicap"] == 0.0
    assert "gender" in monitoring_features(df.select("gender")).columns
    with pytest.raises(ValueError):
        monitoring_features(df.select("no_show"))


def test_adapter_numbers_at_small_scale(spark):
    """Anchors of the flagship query on the driver's sf0.01 tables."""
    rows = QUERIES["asof_history_by_split"](spark, SF.replace("0.001", "0.01")).collect()
    assert {r["split"]: r["n"] for r in rows} == {"train": 10327, "val": 2186, "test": 1276}
    assert sum(r["appointments"] for r in rows) == 58871
    assert sum(r["missed"] for r in rows) == 19170
    assert max(r["longest"] for r in rows) == 19
    assert SPLIT.train_end == "1999-12-31"
