"""Cleaning, labels and splits."""

from pyspark.sql import functions as F

from riskspark.functions import clip_upper, normalize_label
from riskspark.operators.clean import drop_invalid, entity_overlap, normalize_request, parse_times
from riskspark.operators.profile import split_sizes
from riskspark.plans.adapter import appointments, table
from riskspark.plans.queries.base import APPT, CLEAN, query, rows, stamp


@query(
    "parsed_times",
    """SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 2 = 0
      THEN o_orderdate ELSE o_orderdate - INTERVAL 3 HOUR END, '%Y-%m-%d %H:%M:%S') AS at FROM orders""",
)
def parsed_times(spark, sf_dir):
    """Dates, times with an offset, and text that is no time."""
    orders = table(spark, sf_dir, "orders")
    offset = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00"))
    text = (
        F.when(F.col("o_orderkey") % 41 == 0, "soon")
        .when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(offset)
    )
    return stamp(parse_times(orders.select("o_orderkey", text.alias("at")), ["at"]), "at")


@query(
    "cleaned_rows",
    f"""WITH {CLEAN} SELECT appointment_id, patient_id, age, handcap, target, split FROM cleaned""",
)
def cleaned_rows(spark, sf_dir):
    return rows(spark, sf_dir).select(
        "appointment_id", "patient_id", "age", "handcap", "target", "split"
    )


@query(
    "kept_rows",
    f"""WITH {APPT} SELECT appointment_id FROM appt
    WHERE age >= 0 AND date_trunc('day', scheduled_day) <= appointment_day""",
)
def kept_rows(spark, sf_dir):
    return drop_invalid(appointments(spark, sf_dir, place=False)).select("appointment_id")


@query(
    "handicap_levels",
    f"""WITH {APPT} SELECT CASE WHEN handcap = 5 THEN NULL WHEN handcap > 1 THEN 1 ELSE handcap END AS handcap,
      count(*) AS n FROM appt GROUP BY 1""",
)
def handicap_levels(spark, sf_dir):
    """Levels above 1 collapse and an unknown level stays unknown."""
    df = appointments(spark, sf_dir, place=False)
    known = F.when(F.col("handcap") != 5, F.col("handcap"))
    return df.groupBy(clip_upper(known, 1).alias("handcap")).agg(F.count(F.lit(1)).alias("n"))


@query("split_counts", f"WITH {CLEAN} SELECT split, count(*) AS n FROM cleaned GROUP BY 1")
def split_counts(spark, sf_dir):
    return split_sizes(rows(spark, sf_dir))


@query(
    "entities_in_two_splits",
    f"""WITH {CLEAN}, f AS (SELECT patient_id, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS a,
      max(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS b,
      max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS c FROM cleaned GROUP BY 1)
    SELECT count(*) FILTER (WHERE a = 1 AND b = 1) AS train_val,
      count(*) FILTER (WHERE a = 1 AND c = 1) AS train_test,
      count(*) FILTER (WHERE b = 1 AND c = 1) AS val_test FROM f""",
)
def entities_in_two_splits(spark, sf_dir):
    return entity_overlap(rows(spark, sf_dir))


@query(
    "normalized_requests",
    f"""WITH {APPT} SELECT appointment_id, upper(trim('  ' || lower(neighbourhood) || ' ')) AS neighbourhood,
      CASE WHEN handcap > 1 THEN 1 ELSE handcap END AS handcap,
      strftime(scheduled_day, '%Y-%m-%d %H:%M:%S') AS scheduled_day FROM appt""",
)
def normalized_requests(spark, sf_dir):
    df = appointments(spark, sf_dir)
    place = F.concat(F.lit("  "), F.lower("neighbourhood"), F.lit(" "))
    text = F.date_format("scheduled_day", "yyyy-MM-dd'T'HH:mm:ss")
    sent = df.withColumns({"neighbourhood": place, "scheduled_day": text})
    found = normalize_request(sent)
    return stamp(found.select("appointment_id", "neighbourhood", "handcap", "scheduled_day"), "scheduled_day")


_WORDS = [" Yes", "y", "TRUE ", "1", "No", "n", "False", "0", "maybe", ""]


@query(
    "normalized_labels",
    """WITH w AS (SELECT o_orderkey, [' Yes', 'y', 'TRUE ', '1', 'No', 'n', 'False', '0', 'maybe', ''][o_orderkey % 10 + 1] AS word,
      CAST(o_orderkey % 4 AS DOUBLE) / 2 AS number FROM orders)
    SELECT o_orderkey, CASE WHEN lower(trim(word)) IN ('yes', 'y', 'true', '1') THEN 1
      WHEN lower(trim(word)) IN ('no', 'n', 'false', '0') THEN 0 END AS from_text,
      CASE WHEN number IN (0, 1) THEN CAST(number AS INTEGER) END AS from_number FROM w""",
)
def normalized_labels(spark, sf_dir):
    key = F.col("o_orderkey")
    word = F.get(F.array(*[F.lit(w) for w in _WORDS]), (key % 10).cast("int"))
    number = (key % 4).cast("double") / 2
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        normalize_label(word).alias("from_text"),
        normalize_label(number, numeric=True).alias("from_number"),
    )


