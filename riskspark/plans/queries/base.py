"""Query registry, and the Spark and SQL forms of the shared inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.clean import clean, time_split, with_target
from riskspark.plans.adapter import SPLIT, appointments

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) function and, where there is one, its SQL."""

    def add(function):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def r6(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


def stamp(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, which compares the same everywhere."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def rows(spark: SparkSession, sf_dir: str, place: bool = False) -> DataFrame:
    """Cleaned appointments with split and target."""
    return with_target(time_split(clean(appointments(spark, sf_dir, place)), SPLIT))


EXPERIMENTS = {"first": (7919, 1000), "second": (104729, 1000), "third": (1299709, 997)}


def experiment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three scores per cleaned appointment: (experiment, appointment_id, score, target, split)."""
    key = F.col("appointment_id")
    scores = [
        F.struct(F.lit(name).alias("experiment"), (key * m % n / F.lit(float(n))).alias("score"))
        for name, (m, n) in EXPERIMENTS.items()
    ]
    return rows(spark, sf_dir).select(
        "appointment_id", "target", "split", F.inline(F.array(*scores))
    )


def _flag(name: str, n: int) -> str:
    return f"CASE WHEN o_orderkey % {n} = 0 THEN 1 ELSE 0 END AS {name}"


APPT = f"""appt AS (
  SELECT CAST(o_custkey + 1 AS DOUBLE) AS patient_id, o_orderkey AS appointment_id,
    CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    o_orderdate AS scheduled_day,
    o_orderdate + to_days(CAST(o_orderkey % 34 - 2 AS INTEGER)) AS appointment_day,
    CAST(o_orderkey % 130 - 3 AS INTEGER) AS age, n_name AS neighbourhood,
    {_flag('scholarship', 7)}, {_flag('hipertension', 5)}, {_flag('diabetes', 11)},
    {_flag('alcoholism', 13)}, {_flag('sms_received', 3)},
    CAST(o_orderkey % 6 AS INTEGER) AS handcap,
    CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS no_show,
    (o_orderkey * 7919 % 1000) / CAST(1000 AS DOUBLE) AS score
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

CLEAN = f"""{APPT}, cleaned AS (
  SELECT patient_id, appointment_id, gender, scheduled_day, appointment_day, age, neighbourhood,
    scholarship, hipertension, diabetes, alcoholism, sms_received,
    CASE WHEN handcap > 1 THEN 1 ELSE handcap END AS handcap, no_show, score,
    CASE WHEN no_show = 'Yes' THEN 1 ELSE 0 END AS target,
    CASE WHEN appointment_day <= TIMESTAMP '1999-12-31' THEN 'train'
         WHEN appointment_day <= TIMESTAMP '2000-12-31' THEN 'val' ELSE 'test' END AS split
  FROM appt WHERE age >= 0 AND date_trunc('day', scheduled_day) <= appointment_day)"""

HISTORY = f"""{CLEAN}, known AS (
  SELECT q.*, coalesce(h.n, 0) AS prev_n, coalesce(h.k, 0) AS prev_k
  FROM cleaned q LEFT JOIN (
    SELECT a.appointment_id, count(*) AS n, sum(t.target) AS k
    FROM cleaned a JOIN cleaned t ON a.patient_id = t.patient_id AND t.split = 'train'
      AND CAST(t.appointment_day AS DATE) < CAST(a.scheduled_day AS DATE)
    GROUP BY 1) h ON q.appointment_id = h.appointment_id)"""

SCORES = CLEAN + ", scores AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS experiment, appointment_id, target, split, "
    f"(appointment_id * {m} % {n}) / CAST({n} AS DOUBLE) AS score FROM cleaned"
    for name, (m, n) in EXPERIMENTS.items()
) + ")"

REQ = """req AS (
  SELECT event_id AS request_id, ts, event_type AS path,
    CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value AS latency_ms,
    (event_id * 7919 % 1000) / CAST(1000 AS DOUBLE) AS score, user_id AS caller
  FROM events)"""


def curve_sql(source: str, by: str) -> str:
    """CTEs pts and cur: running counts per group from the highest score down."""
    return f"""pts AS (
  SELECT {by}, score, sum(target) AS pos, count(*) AS n FROM {source} GROUP BY {by}, score),
cur AS (SELECT *,
    sum(pos) OVER (PARTITION BY {by} ORDER BY score DESC) AS tp,
    sum(n) OVER (PARTITION BY {by} ORDER BY score DESC) AS alerts,
    sum(pos) OVER (PARTITION BY {by}) AS all_pos, sum(n) OVER (PARTITION BY {by}) AS all_n
  FROM pts)"""
