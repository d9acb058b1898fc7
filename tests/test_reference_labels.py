import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskspark.operators import drift as D
from riskspark.operators import reference as R
from riskspark.plans.queries.streams import arriving
from riskspark.streaming.feedback import label_supply, labels_stream

SCHEMA = "x double, flag int, c string, w string"


def part(spark, seed, n, shift=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = rng.choice([None, float("nan"), 5.0, 5.0, round(rng.gauss(shift, 2), 1)])
        rows.append((x, rng.randrange(2), rng.choice(["a", "b", "new" if shift else "old", None]), f"w{i % 3}"))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("profile"))
    ref = part(spark, 1, 700)
    R.write_profile(R.fit_profile(ref, ["x", "flag"], ["c"], "v1"), path)
    R.write_profile(R.fit_profile(ref.limit(50), ["x"], [], "v2"), path)
    return ref, R.read_profile(spark, path, "v1"), path


def psi(df):
    return {r["feature"]: pytest.approx(r["psi"], abs=1e-9) for r in df.collect()}


def test_profile_gives_what_both_tables_give(spark, stored):
    ref, profile, _ = stored
    cur = part(spark, 2, 300, shift=1.5)
    wanted = {**psi(D.psi_numeric(ref, cur, ["x", "flag"])), **psi(D.psi_categorical(ref, cur, ["c"]))}
    found = R.psi_from_profile(profile, cur)
    assert psi(found) == wanted and wanted["x"] != pytest.approx(0.0)
    assert all("profile" in f for f in found.inputFiles())
    empty = {r["feature"]: r["psi"] for r in R.psi_from_profile(profile, cur.limit(0)).collect()}
    assert empty["x"] == empty["flag"] == 0 and empty["c"] == D.psi_categorical(ref, cur.limit(0), ["c"]).first()["psi"]


def test_groups_of_new_rows(spark, stored):
    ref, profile, _ = stored
    cur = part(spark, 3, 300, shift=1.0)
    counts = R.binned_counts(profile, cur.select("x", "flag", "c", F.col("w").alias("week")), [F.col("week")])
    found = R.psi_of_profile(profile, counts, ["week"]).collect()
    assert len(found) == 9
    for w in ("w0", "w1", "w2"):
        own = cur.where(F.col("w") == w)
        wanted = psi(D.psi_numeric(ref, own, ["x", "flag"]))
        assert {r["feature"]: r["psi"] for r in found if r["week"] == w and r["feature"] != "c"} == wanted


def test_profiles_of_parts_add_up(spark, stored):
    ref, profile, path = stored
    more = part(spark, 4, 200)

    def rows(df):
        return Counter((r["feature"], r["numeric"], r["bin"], r["n"]) for r in df.collect())

    both = R.refit_counts(profile, more)
    counts = {(r["feature"], r["bin"]): r["cur"] for r in R.binned_counts(profile, ref.unionByName(more)).collect()}
    assert {(r["feature"], r["bin"]): r["n"] for r in both.collect()} == counts
    assert rows(R.merge_profiles(profile, both)) == Counter(
        (r["feature"], r["numeric"], r["bin"], r["n"] + {(p["feature"], p["bin"]): p["n"] for p in profile.collect()}.get((r["feature"], r["bin"]), 0))
        for r in both.collect()
    )
    assert {r["version"] for r in both.collect()} == {"v1"}
    with pytest.raises(ValueError, match="edges"):
        R.merge_profiles(profile, R.read_profile(spark, path, "v2"))


START = datetime(2024, 1, 1)


def hour(n):
    return START + timedelta(hours=n)


def test_labels_that_never_come_leave_the_state(spark):
    rng = random.Random(6)
    predictions, outcomes = [], []
    for i in range(200):
        at = rng.randrange(400)
        predictions.append((i, at / 10, hour(at)))
        if i % 4:
            outcomes.append((i, i % 2, hour(at + rng.choice([-5, 0, 3, 24, 25, 80]))))
    tick = hour(2000)

    def rounds(rows, last, schema):
        every = [[r for r in rows if a <= r[2] < b] for a, b in ((hour(-9), hour(150)), (hour(150), hour(300)), (hour(300), hour(999)))]
        return [spark.createDataFrame(part, schema) for part in [*every, [last]]]

    slices = {
        "predictions": rounds(predictions, (-1, None, tick), "id long, score double, at timestamp"),
        "outcomes": rounds(outcomes, (-1, None, tick), "id long, label int, known timestamp"),
    }
    stream = lambda predictions, outcomes: labels_stream(predictions, outcomes, "id", "at", "known", "24 hours")
    progress = []
    found = arriving(spark, slices, stream, "labels-test", progress).where("id >= 0")
    known = {i: (label, at) for i, label, at in outcomes}
    wanted = {}
    for i, _, at in predictions:
        label, when = known.get(i, (None, None))
        in_time = when is not None and at <= when <= at + timedelta(hours=24)
        wanted[i] = (label, when, "labeled") if in_time else (None, None, "expired")
    assert {r["id"]: (r["label"], r["known"], r["label_state"]) for r in found.collect()} == wanted
    assert found.count() == 200
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert held[-1] <= 2 and max(held) < 200
    supply = label_supply(found, "at", "3650 days").first()
    counts = Counter(s for *_, s in wanted.values())
    assert (supply["labeled"], supply["expired"]) == (counts["labeled"], counts["expired"])
    assert supply["action"] == "WAIT_FOR_LABELS"
