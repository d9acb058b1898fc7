"""Features and history."""

from pyspark.sql import functions as F

from riskspark.operators.clean import split_part
from riskspark.operators.features import (
    FeatureBuilder,
    FeatureBuilderModel,
    base_features,
    feature_parity,
    monitoring_features,
)
from riskspark.operators.history import asof_history, fit_history
from riskspark.operators.history_store import HistoryStore
from riskspark.plans.adapter import SPLIT, appointments
from riskspark.plans.queries.base import APPT, CLEAN, HISTORY, query, r6, rows
from riskspark.schema import ROLES
from riskspark.session import shared_dir

_BASE = """CAST(greatest(date_diff('day', scheduled_day, appointment_day), 0) AS INTEGER) AS lead_time_days,
    dayname(appointment_day) AS appointment_weekday,
    CASE WHEN age <= 12 THEN 'child' WHEN age <= 18 THEN 'teen' WHEN age <= 35 THEN 'young_adult'
      WHEN age <= 55 THEN 'adult' WHEN age <= 75 THEN 'senior' ELSE 'elderly' END AS age_group"""


@query("base_features", f"WITH {APPT} SELECT appointment_id, {_BASE} FROM appt")
def base_feature_columns(spark, sf_dir):
    """Raw rows, so that some are booked after their day and clip to 0."""
    return base_features(appointments(spark, sf_dir, place=False)).select(
        "appointment_id", "lead_time_days", "appointment_weekday", "age_group"
    )


@query(
    "patient_history",
    f"""WITH {CLEAN}, d AS (SELECT patient_id AS entity, CAST(appointment_day AS DATE) AS day,
      count(*) AS n, sum(target) AS k FROM cleaned WHERE split = 'train' GROUP BY 1, 2)
    SELECT entity, strftime(day, '%Y-%m-%d') AS day, n, CAST(k AS BIGINT) AS k,
      CAST(sum(n) OVER w AS BIGINT) AS cum_n, CAST(sum(k) OVER w AS BIGINT) AS cum_k
    FROM d WINDOW w AS (PARTITION BY entity ORDER BY day)""",
)
def patient_history(spark, sf_dir):
    train = split_part(rows(spark, sf_dir), "train", SPLIT)
    return fit_history(train).withColumn("day", F.col("day").cast("string"))


@query(
    "asof_history",
    f"""WITH {HISTORY} SELECT appointment_id, split, CAST(prev_n AS DOUBLE) AS previous_appointments,
      round(CASE WHEN prev_n = 0 THEN 0 ELSE prev_k / CAST(prev_n AS DOUBLE) END, 6) AS previous_miss_rate
    FROM known""",
)
def asof_patient_history(spark, sf_dir):
    """What the train part told about each patient before each booking."""
    cleaned = rows(spark, sf_dir).select("appointment_id", "patient_id", "scheduled_day", "appointment_day", "split", "target")
    history = fit_history(split_part(cleaned, "train", SPLIT))
    found = asof_history(cleaned, history).select(
        "appointment_id", "split", "previous_appointments", "previous_miss_rate"
    )
    return r6(found, "previous_miss_rate")


@query(
    "asof_history_from_deltas",
    f"""WITH {HISTORY} SELECT appointment_id, split, CAST(prev_n AS DOUBLE) AS previous_appointments,
      round(CASE WHEN prev_n = 0 THEN 0 ELSE prev_k / CAST(prev_n AS DOUBLE) END, 6) AS previous_miss_rate
    FROM known""",
)
def asof_history_from_deltas(spark, sf_dir):
    """The train part as a base and three deltas, compacted once, in a bucketed table."""
    cleaned = rows(spark, sf_dir).select("appointment_id", "patient_id", "scheduled_day", "appointment_day", "split", "target")
    store = HistoryStore(spark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    train = split_part(cleaned, "train", SPLIT)
    for year in (1995, 1996, 1997, None):
        of_year = F.year("appointment_day")
        store.append(train.where((of_year > 1997) if year is None else (of_year <= 1995) if year == 1995 else (of_year == year)))
        if year == 1996:
            store.compact()
    found = store.asof(cleaned).select("appointment_id", "split", "previous_appointments", "previous_miss_rate")
    return r6(found, "previous_miss_rate")


@query(
    "asof_history_by_split",
    f"""WITH {HISTORY} SELECT split, count(*) AS n, CAST(sum(prev_n) AS DOUBLE) AS appointments,
      CAST(max(prev_n) AS DOUBLE) AS longest, CAST(sum(prev_k) AS BIGINT) AS missed FROM known GROUP BY 1""",
)
def asof_history_by_split(spark, sf_dir):
    found = asof_patient_history(spark, sf_dir)
    missed = F.col("previous_appointments") * F.col("previous_miss_rate")
    return found.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("previous_appointments").alias("appointments"),
        F.max("previous_appointments").alias("longest"),
        F.sum(F.round(missed).cast("long")).alias("missed"),
    )


@query(
    "monitoring_features",
    f"""WITH {APPT} SELECT CAST(age AS DOUBLE) AS age, gender, neighbourhood,
      CAST(scholarship AS DOUBLE) AS scholarship, CAST(hipertension AS DOUBLE) AS hipertension,
      CAST(diabetes AS DOUBLE) AS diabetes, CAST(alcoholism AS DOUBLE) AS alcoholism,
      CAST(handcap AS DOUBLE) AS handcap, CAST(sms_received AS DOUBLE) AS sms_received,
      round((epoch_us(appointment_day) - epoch_us(scheduled_day + to_hours(CAST(appointment_id % 24 AS INTEGER))))
        / CAST(86400000000 AS DOUBLE), 6) AS lead_time_days,
      CAST((dayofweek(appointment_day) + 6) % 7 AS DOUBLE) AS appointment_weekday FROM appt""",
)
def monitoring_feature_columns(spark, sf_dir):
    """With hours on the booking time, so that lead times are fractional, some negative."""
    df = appointments(spark, sf_dir)
    hours = F.make_dt_interval(hours=(F.col("appointment_id") % 24).cast("int"))
    moved = df.withColumn("scheduled_day", F.col("scheduled_day") + hours)
    return r6(monitoring_features(moved), "lead_time_days")


FEATURES = [
    "lead_time_days",
    "appointment_weekday",
    "age_group",
    "previous_appointments",
    "previous_miss_rate",
]


@query(
    "built_features",
    f"""WITH {HISTORY} SELECT appointment_id, {_BASE}, CAST(prev_n AS DOUBLE) AS previous_appointments,
      round(CASE WHEN prev_n = 0 THEN 0 ELSE prev_k / CAST(prev_n AS DOUBLE) END, 6) AS previous_miss_rate
    FROM known""",
)
def built_features(spark, sf_dir):
    """The fitted feature object over all parts."""
    cleaned = rows(spark, sf_dir)
    model = FeatureBuilder().fit(split_part(cleaned, "train", SPLIT))
    return r6(model.transform(cleaned).select("appointment_id", *FEATURES), "previous_miss_rate")


@query(
    "feature_parity",
    f"""WITH {CLEAN}, f AS (SELECT unnest(['lead_time_days', 'appointment_weekday', 'age_group',
      'previous_appointments', 'previous_miss_rate']) AS feature)
    SELECT feature, (SELECT count(*) FROM cleaned WHERE split = 'test') AS rows, CAST(0 AS BIGINT) AS mismatches FROM f""",
)
def same_features_both_ways(spark, sf_dir):
    """Test rows through the training object, and through its saved and pruned copy."""
    cleaned = rows(spark, sf_dir)
    model = FeatureBuilder().fit(split_part(cleaned, "train", SPLIT))
    path = shared_dir(spark, "feature-builder")
    model.save(path)
    loaded = FeatureBuilderModel.load(spark, path, prune_history=True)
    test = split_part(cleaned, "test", SPLIT)
    return feature_parity(model.transform(test), loaded.transform(test), ROLES.event, FEATURES)
