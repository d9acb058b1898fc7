"""Exploratory profile."""

from pyspark.sql import functions as F

from riskspark.operators import profile
from riskspark.operators.clean import time_split, with_target
from riskspark.plans.adapter import SPLIT, appointments, table
from riskspark.plans.queries.base import APPT, query, r6, stamp


def _raw(spark, sf_dir, place=False):
    return appointments(spark, sf_dir, place)


@query("table_shape", f"WITH {APPT} SELECT count(*) AS rows, 15 AS columns FROM appt")
def table_shape(spark, sf_dir):
    return profile.shape(_raw(spark, sf_dir, place=True))


@query(
    "label_shares",
    f"""WITH {APPT} SELECT no_show AS value, count(*) AS n,
      round(count(*) / CAST((SELECT count(*) FROM appt) AS DOUBLE), 6) AS share FROM appt GROUP BY 1""",
)
def label_shares(spark, sf_dir):
    return r6(profile.value_shares(_raw(spark, sf_dir), "no_show"), "share")


@query(
    "handicap_shares",
    f"""WITH {APPT} SELECT handcap AS value, count(*) AS n,
      round(count(*) / CAST((SELECT count(*) FROM appt) AS DOUBLE), 6) AS share FROM appt GROUP BY 1""",
)
def handicap_shares(spark, sf_dir):
    return r6(profile.value_shares(_raw(spark, sf_dir), "handcap"), "share")


@query(
    "time_ranges",
    f"""WITH {APPT}, r AS (
      SELECT 'scheduled_day' AS "column", min(scheduled_day) AS a, max(scheduled_day) AS b FROM appt
      UNION ALL SELECT 'appointment_day', min(appointment_day), max(appointment_day) FROM appt)
    SELECT "column", strftime(a, '%Y-%m-%d %H:%M:%S') AS "first",
      strftime(b, '%Y-%m-%d %H:%M:%S') AS "last" FROM r""",
)
def time_ranges(spark, sf_dir):
    found = profile.time_ranges(_raw(spark, sf_dir), ["scheduled_day", "appointment_day"])
    return stamp(found, "first", "last")


@query(
    "rows_per_day",
    f"""WITH {APPT} SELECT strftime(appointment_day, '%Y-%m-%d') AS day, count(*) AS n
    FROM appt GROUP BY 1 ORDER BY 1""",
)
def rows_per_day(spark, sf_dir):
    found = profile.rows_per_day(_raw(spark, sf_dir), "appointment_day")
    return found.withColumn("day", F.col("day").cast("string"))


@query(
    "missing_cells",
    """WITH m AS (SELECT count(*) FILTER (WHERE o_custkey % 5 = 0) AS o_custkey,
      count(*) FILTER (WHERE o_orderstatus = 'F') AS o_orderstatus FROM orders)
    SELECT 'o_orderkey' AS "column", 0 AS missing UNION ALL SELECT 'o_custkey', o_custkey FROM m
    UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM m
    UNION ALL SELECT '<total>', o_custkey + o_orderstatus FROM m""",
)
def missing_cells(spark, sf_dir):
    """Some customers and one status blanked out."""
    holes = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    return profile.missing_cells(holes)


@query(
    "duplicate_rows",
    """WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM c""",
)
def duplicate_rows(spark, sf_dir):
    """Orders that repeat customer and status, the id ignored."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return profile.duplicate_rows(df, ignore=["o_orderkey"])


@query(
    "duplicate_keys",
    "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicates FROM lineitem",
)
def duplicate_keys(spark, sf_dir):
    return profile.duplicate_key_count(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "entity_profile",
    f"""WITH {APPT}, c AS (SELECT patient_id, count(*) AS n FROM appt GROUP BY 1)
    SELECT count(*) AS entities, count(*) FILTER (WHERE n > 1) AS repeated, max(n) AS max_rows FROM c""",
)
def entity_profile(spark, sf_dir):
    return profile.entity_profile(_raw(spark, sf_dir), "patient_id")


@query(
    "fractional_ids",
    "SELECT count(*) FILTER (WHERE o_custkey % 10 = 1) AS fractional FROM orders",
)
def fractional_ids(spark, sf_dir):
    """Some ids moved off the whole numbers."""
    shift = F.when((F.col("patient_id") - 1) % 10 == 1, 0.5).otherwise(0.0)
    df = _raw(spark, sf_dir).withColumn("patient_id", F.col("patient_id") + shift)
    return profile.fractional_ids(df, "patient_id")


@query(
    "rule_violations",
    f"""WITH {APPT} SELECT count(*) FILTER (WHERE age < 0) AS negative_age,
      count(*) FILTER (WHERE age > 100) AS age_above_100,
      count(*) FILTER (WHERE date_trunc('day', scheduled_day) > appointment_day) AS booked_late FROM appt""",
)
def rule_violations(spark, sf_dir):
    late = F.date_trunc("day", "scheduled_day") > F.col("appointment_day")
    rules = {
        "negative_age": F.col("age") < 0,
        "age_above_100": F.col("age") > 100,
        "booked_late": late,
    }
    return profile.rule_counts(_raw(spark, sf_dir), rules)


@query(
    "raw_split_sizes",
    f"""WITH {APPT} SELECT CASE WHEN appointment_day <= TIMESTAMP '1999-12-31' THEN 'train'
      WHEN appointment_day <= TIMESTAMP '2000-12-31' THEN 'val' ELSE 'test' END AS split,
      count(*) AS n FROM appt GROUP BY 1""",
)
def raw_split_sizes(spark, sf_dir):
    return profile.split_sizes(time_split(_raw(spark, sf_dir), SPLIT))


_DAYS = """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE day(o_orderdate) NOT IN (13, 14)),
  s AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM d)
  SELECT strftime(s.day, '%Y-%m-%d') AS day FROM s ANTI JOIN d ON CAST(s.day AS DATE) = d.day"""


@query("calendar_gaps", _DAYS)
def calendar_gaps(spark, sf_dir):
    """Days without an order, once the 13th and 14th of each month are left out."""
    df = table(spark, sf_dir, "orders").where(~F.dayofmonth("o_orderdate").isin(13, 14))
    return profile.calendar_gaps(df, "o_orderdate").withColumn("day", F.col("day").cast("string"))


@query(
    "label_rate_by_month",
    f"""WITH {APPT} SELECT strftime(date_trunc('month', appointment_day), '%Y-%m-%d') AS month,
      count(*) AS n, round(avg(CASE WHEN no_show = 'Yes' THEN 1.0 ELSE 0.0 END), 6) AS rate
    FROM appt GROUP BY 1""",
)
def label_rate_by_month(spark, sf_dir):
    df = with_target(_raw(spark, sf_dir))
    found = profile.rate_by_month(df, "appointment_day", "target")
    return r6(found.withColumn("month", F.col("month").cast("string")), "rate")
