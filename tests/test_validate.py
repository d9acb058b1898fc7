import hashlib

import pytest
from pyspark.sql import functions as F

from riskspark.operators.validate import (
    check_columns,
    check_split,
    check_split_sizes,
    check_unique,
    coerce_types,
    failure_report,
    require_rows,
    require_valid,
)
from riskspark.plans.validation import validate_files
from riskspark.schema import RAW_FIELDS, TABLE_FIELDS
from riskspark.sources.readers import file_digest, ingest, read_raw, table_fingerprint, verify_digest
from riskspark.streaming.scoring import accepted_rows, judge

# Own records: one plain row, and what each case changes in it.
PLAIN = {
    "PatientId": "77.5", "AppointmentID": "910001", "Gender": "M", "ScheduledDay": "2015-02-03T11:15:00Z",
    "AppointmentDay": "2015-02-20", "Age": "41", "Neighbourhood": "NORDHAFEN", "Scholarship": "1",
    "Hipertension": "0", "Diabetes": "1", "Alcoholism": "0", "Handcap": "1", "SMS_received": "0", "No-show": "Yes",
}
HEADER = ",".join(PLAIN)


def line(**changes):
    """A record as text; names with a dash are written with an underscore."""
    return ",".join({**PLAIN, **{k.replace("No_show", "No-show"): v for k, v in changes.items()}}.values())


GOOD = [line(), line(AppointmentID="910002", Age="-1", Handcap="4"), line(AppointmentID="910003", Gender="F", Age="120")]
# One cell out of every domain of the contract but the label's and the dates'.
BAD = [line(Gender="other", Diabetes="9", PatientId="0")]
TWINS = [line(AppointmentID="910009"), line(AppointmentID="910009", Alcoholism="-1"), line(AppointmentID="910010")]


def write(folder, name, lines):
    path = folder / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def failures(df, fields=TABLE_FIELDS, key="appointment_id"):
    rows = failure_report(df, fields, [key]).collect()
    return sorted((r["column"], r["check"]) for r in rows)


def test_good_file_passes_and_bad_file_names_three_columns(spark, tmp_path):
    good = read_raw(spark, write(tmp_path, "good.csv", GOOD))
    assert check_columns(good, RAW_FIELDS) == []
    assert require_valid(good, RAW_FIELDS, ["AppointmentID"]) is good
    bad = read_raw(spark, write(tmp_path, "bad.csv", BAD))
    found = failures(bad, RAW_FIELDS, "AppointmentID")
    assert [c for c, _ in found] == ["Diabetes", "Gender", "PatientId"]
    with pytest.raises(ValueError, match="invalid table"):
        require_valid(bad, RAW_FIELDS, ["AppointmentID"])


def test_every_row_of_a_repeated_key_fails(spark, tmp_path):
    raw = read_raw(spark, write(tmp_path, "twins.csv", TWINS))
    assert failures(raw, RAW_FIELDS, "AppointmentID") == [
        ("Alcoholism", "isin(0, 1)"), ("AppointmentID", "unique"), ("AppointmentID", "unique"),
    ]


@pytest.mark.parametrize(
    "column, value, check",
    [
        # Just outside each domain, a wrong type, a null, and times that do not parse.
        ("patient_id", "-0.5", "greater_than(0)"),
        ("patient_id", "p77", "dtype(double)"),
        ("gender", "", "isin(F, M)"),
        ("age", "-7", "in_range(-1, 120)"),
        ("age", "9000", "in_range(-1, 120)"),
        ("diabetes", "0.25", "dtype(int)"),
        ("alcoholism", "3", "isin(0, 1)"),
        ("handcap", "-1", "in_range(0, 4)"),
        ("scholarship", None, "not_null"),
        ("no_show", "no", "isin(Yes, No)"),
        ("scheduled_day", "3rd of May", "parses_as_time"),
        ("appointment_day", "2015-02-30", "parses_as_time"),
    ],
)
def test_one_bad_cell_is_one_failure(appointments, column, value, check):
    df = appointments({column: value}, {}, text=True)
    assert failures(df) == [(column, check)]


def test_edges_of_domains_pass(appointments):
    df = appointments({"age": -1}, {"age": 120}, {"handcap": 4}, {"patient_id": 0.5}, text=True)
    assert failures(df) == []


def test_missing_extra_and_empty(spark, appointments):
    df = appointments({}, text=True)
    assert check_columns(df.drop("age"), TABLE_FIELDS) == [("age", "column_in_dataframe")]
    assert check_columns(df.withColumn("x", F.lit(1)), TABLE_FIELDS) == [("x", "column_in_schema")]
    with pytest.raises(ValueError, match="empty"):
        require_rows(df.where("false"))


def test_missing_words_become_null(spark, tmp_path):
    path = write(tmp_path, "na.csv", [x.replace("NORDHAFEN", w) for x, w in zip(GOOD, ["N/A", ""])])
    raw = read_raw(spark, path)
    assert raw.where("Neighbourhood IS NULL").count() == 2
    assert failures(raw, RAW_FIELDS, "AppointmentID") == [("Neighbourhood", "not_null")] * 2
    typed = ingest(raw)
    assert dict(typed.dtypes)["patient_id"] == "double"


def test_coerce_keeps_good_and_nulls_bad(appointments):
    row = coerce_types(appointments({"age": "x", "handcap": "3"}, text=True), TABLE_FIELDS).first()
    assert row["age"] is None and row["handcap"] == 3


def test_unique_reports_every_copy_of_a_hot_key(spark):
    rows = spark.range(3000).withColumn("k", F.when(F.col("id") < 1000, -1).otherwise(F.col("id")))
    found = check_unique(rows, "k")
    assert found.count() == 1000 and found.where("k <> -1").count() == 0


def test_file_verdicts(spark, tmp_path):
    paths = {
        name: write(tmp_path, name, lines)
        for name, lines in (("good", GOOD), ("bad", BAD), ("twins", TWINS), ("none", []))
    }
    extra = tmp_path / "extra"
    extra.write_text(HEADER + ",More\n" + GOOD[0] + ",1\n")
    paths["extra"] = str(extra)
    names = {path: name for name, path in paths.items()}
    found = {names[r["file"]]: r for r in validate_files(spark, list(paths.values())).collect()}
    problems = {name: r["problems"] for name, r in found.items()}
    assert problems == {"good": 0, "bad": 3, "twins": 3, "none": 1, "extra": 1}
    assert [name for name, r in found.items() if r["expected"]] == ["good"]
    failing = validate_files(spark, list(paths.values()), expect_fail=True)
    assert [names[r["file"]] for r in failing.where("NOT expected").collect()] == ["good"]
    only = validate_files(spark, [paths["extra"]]).first()
    assert only["status"] == "INVALID"


def test_digest(spark, tmp_path):
    path = write(tmp_path, "good.csv", GOOD)
    wanted = hashlib.sha256(open(path, "rb").read()).hexdigest()
    assert verify_digest(spark, path, wanted) == wanted
    assert file_digest(spark, path).count() == 1
    with pytest.raises(ValueError, match="mismatch"):
        verify_digest(spark, path, "0" * 64)


def test_fingerprint_ignores_order_and_sees_changes(appointments):
    a, b = appointments({}, {"age": 40}), appointments({}, {"age": 41})
    assert table_fingerprint(a).first() == table_fingerprint(a.repartition(3).orderBy("age")).first()
    assert table_fingerprint(a).first() != table_fingerprint(b).first()


REQUEST = {
    "request_id": "r-8", "patient_id": "512.25", "gender": "M", "scheduled_day": "2015-06-01T23:59:00Z",
    "appointment_day": "2015-06-19", "age": "33", "neighbourhood": "NORDHAFEN", "scholarship": "1",
    "hipertension": "0", "diabetes": "1", "alcoholism": "1", "handcap": "2", "sms_received": "0", "no_show": None,
}
FLAGS = ("scholarship", "hipertension", "diabetes", "alcoholism", "sms_received")


def request_cases():
    """Both sides of the edge of every rule of a request."""
    inside = {"age": ("0", "120"), "handcap": ("0", "4"), "gender": ("F",), "neighbourhood": ("Ö", "x" * 100)}
    outside = {"age": ("-1", "121", "3.5"), "handcap": ("5",), "gender": ("m",), "neighbourhood": ("x" * 101,)}
    inside |= {flag: ("0", "1") for flag in FLAGS}
    outside |= {flag: ("2", "-1") for flag in FLAGS}
    outside |= {"patient_id": ("-3",), "appointment_day": ("later",), "no_show": ("Yes",)}
    cases = [({name: value}, []) for name, values in inside.items() for value in values]
    cases += [({name: value}, [name]) for name, values in outside.items() for value in values]
    # Booked on the day itself, at its last minute; booked the day after.
    cases.append(({"scheduled_day": "2015-06-19T23:59:59Z"}, []))
    cases.append(({"scheduled_day": "2015-06-20T00:00:00Z"}, ["scheduled_day"]))
    return cases


def test_request_rules(spark):
    cases = request_cases()
    rows = [tuple({**REQUEST, "request_id": str(i), **change}.values()) for i, (change, _) in enumerate(cases)]
    judged = judge(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in REQUEST)))
    reasons = {int(r["request_id"]): [f["column"] for f in r["reasons"]] for r in judged.collect()}
    assert [reasons[i] for i in range(len(cases))] == [columns for _, columns in cases]
    good = accepted_rows(judged, ("request_id",)).collect()
    assert {int(r["request_id"]) for r in good} == {i for i, (_, columns) in enumerate(cases) if not columns}
    assert all(r["handcap"] <= 1 and r["neighbourhood"].isupper() for r in good)


def test_absent_request_field_is_a_failure(spark):
    row = {k: v for k, v in REQUEST.items() if k != "diabetes"}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    assert [f["column"] for f in judge(df).first()["reasons"]] == ["diabetes"]


def test_split_checks(spark):
    df = spark.createDataFrame(
        [("train", 1), ("train", 0), ("val", 1)], "split string, target int"
    )
    found = {r["split"]: r for r in check_split(df, "target", ["train", "val", "test"]).collect()}
    assert found["train"]["ok"] and not found["val"]["ok"]
    assert found["test"]["n"] == 0 and not found["test"]["ok"]
    a = spark.createDataFrame([("train", 2), ("val", 1)], "split string, n long")
    b = spark.createDataFrame([("train", 2), ("test", 1)], "split string, n long")
    same = {r["split"]: r["same"] for r in check_split_sizes(a, b).collect()}
    assert same == {"train": True, "val": False, "test": False}
