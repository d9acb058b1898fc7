"""Validation of a raw text table with planted errors."""

from dataclasses import replace

from pyspark.sql import functions as F

from riskspark.operators.clean import time_split
from riskspark.operators.profile import split_sizes
from riskspark.operators.registry import KeyRegistry
from riskspark.operators.validate import (
    check_split,
    check_split_sizes,
    check_unique,
    coerce_types,
    failure_report,
    failure_summary,
    file_verdicts,
    split_requests,
)
from riskspark.plans.adapter import SPLIT, appointments
from riskspark.plans.queries.base import APPT, CLEAN, query, rows
from riskspark.schema import REQUEST_FIELDS, TABLE_FIELDS
from riskspark.session import shared_dir
from riskspark.streaming.scoring import judge


def dirty(spark, sf_dir):
    """All appointments as text with planted errors; ``row_id`` tells copies apart."""
    df = appointments(spark, sf_dir)
    key = F.col("appointment_id")
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    age = F.col("age").cast("string")
    return df.select(
        key.alias("row_id"),
        F.when(key % 89 == 0, "-5.0").otherwise(F.col("patient_id").cast("string")).alias("patient_id"),
        F.when(key % 97 == 1, key - 1).otherwise(key).cast("string").alias("appointment_id"),
        F.when(key % 83 == 0, "X").otherwise(F.col("gender")).alias("gender"),
        F.when(key % 79 == 0, "soon").otherwise(F.date_format("scheduled_day", iso)).alias("scheduled_day"),
        F.date_format("appointment_day", iso).alias("appointment_day"),
        F.when(key % 73 == 0, "old").when(key % 71 == 0, F.concat(age, F.lit(".5"))).otherwise(age).alias("age"),
        F.when(key % 67 != 0, F.col("neighbourhood")).alias("neighbourhood"),
        F.col("scholarship").cast("string").alias("scholarship"),
        F.when(key % 61 == 0, "2").otherwise(F.col("hipertension").cast("string")).alias("hipertension"),
        F.col("diabetes").cast("string").alias("diabetes"),
        F.col("alcoholism").cast("string").alias("alcoholism"),
        F.col("handcap").cast("string").alias("handcap"),
        F.col("sms_received").cast("string").alias("sms_received"),
        F.when(key % 59 == 0, "Maybe").otherwise(F.col("no_show")).alias("no_show"),
    )


DIRTY = f"""{APPT}, dirty AS (SELECT appointment_id AS row_id,
    CASE WHEN appointment_id % 89 = 0 THEN '-5.0' ELSE CAST(patient_id AS VARCHAR) END AS patient_id,
    CAST(CASE WHEN appointment_id % 97 = 1 THEN appointment_id - 1 ELSE appointment_id END AS VARCHAR) AS appointment_id,
    CASE WHEN appointment_id % 83 = 0 THEN 'X' ELSE gender END AS gender,
    CASE WHEN appointment_id % 79 = 0 THEN 'soon' ELSE strftime(scheduled_day, '%Y-%m-%dT%H:%M:%SZ') END AS scheduled_day,
    strftime(appointment_day, '%Y-%m-%dT%H:%M:%SZ') AS appointment_day,
    CASE WHEN appointment_id % 73 = 0 THEN 'old' WHEN appointment_id % 71 = 0 THEN age || '.5' ELSE CAST(age AS VARCHAR) END AS age,
    CASE WHEN appointment_id % 67 <> 0 THEN neighbourhood END AS neighbourhood,
    CASE WHEN appointment_id % 61 = 0 THEN '2' ELSE CAST(hipertension AS VARCHAR) END AS hipertension,
    CAST(handcap AS VARCHAR) AS handcap, CAST(sms_received AS VARCHAR) AS sms_received,
    CASE WHEN appointment_id % 59 = 0 THEN 'Maybe' ELSE no_show END AS no_show,
    CASE WHEN regexp_matches(CASE WHEN appointment_id % 73 = 0 THEN 'old' WHEN appointment_id % 71 = 0 THEN age || '.5' ELSE CAST(age AS VARCHAR) END, '^-?[0-9]+$') THEN age END AS typed_age
  FROM appt)"""


def _cells(low_age: int) -> str:
    return f"""SELECT row_id, 'patient_id' AS "column", 'greater_than(0)' AS "check", patient_id AS "value" FROM dirty WHERE CAST(patient_id AS DOUBLE) <= 0
    UNION ALL SELECT row_id, 'gender', 'isin(F, M)', gender FROM dirty WHERE gender NOT IN ('F', 'M')
    UNION ALL SELECT row_id, 'scheduled_day', 'parses_as_time', scheduled_day FROM dirty WHERE scheduled_day = 'soon'
    UNION ALL SELECT row_id, 'age', 'dtype(int)', age FROM dirty WHERE typed_age IS NULL
    UNION ALL SELECT row_id, 'age', 'in_range({low_age}, 120)', age FROM dirty WHERE typed_age NOT BETWEEN {low_age} AND 120
    UNION ALL SELECT row_id, 'neighbourhood', 'not_null', neighbourhood FROM dirty WHERE neighbourhood IS NULL
    UNION ALL SELECT row_id, 'hipertension', 'isin(0, 1)', hipertension FROM dirty WHERE hipertension NOT IN ('0', '1')
    UNION ALL SELECT row_id, 'handcap', 'in_range(0, 4)', handcap FROM dirty WHERE CAST(handcap AS INTEGER) > 4"""


REPORT = f"""{DIRTY}, report AS ({_cells(-1)}
    UNION ALL SELECT row_id, 'no_show', 'isin(Yes, No)', no_show FROM dirty WHERE no_show NOT IN ('Yes', 'No')
    UNION ALL SELECT row_id, 'appointment_id', 'unique', appointment_id FROM dirty WHERE appointment_id IN
      (SELECT appointment_id FROM dirty GROUP BY 1 HAVING count(*) > 1))"""


@query("failing_cells", f'WITH {REPORT} SELECT row_id, "column", "check", "value" FROM report')
def failing_cells(spark, sf_dir):
    return failure_report(dirty(spark, sf_dir), TABLE_FIELDS, ["row_id"])


@query(
    "failing_cells_by_check",
    f'WITH {REPORT} SELECT "column", "check", count(*) AS failures FROM report GROUP BY 1, 2',
)
def failing_cells_by_check(spark, sf_dir):
    return failure_summary(failing_cells(spark, sf_dir))


@query(
    "typed_columns",
    f"""WITH {DIRTY} SELECT CAST(appointment_id AS BIGINT) AS appointment_id, typed_age AS age,
      CAST(patient_id AS DOUBLE) AS patient_id, CAST(hipertension AS INTEGER) AS hipertension FROM dirty""",
)
def typed_columns(spark, sf_dir):
    typed = coerce_types(dirty(spark, sf_dir), TABLE_FIELDS)
    return typed.select("appointment_id", "age", "patient_id", "hipertension")


@query(
    "duplicate_key_rows",
    f"""WITH {DIRTY} SELECT row_id, appointment_id FROM dirty WHERE appointment_id IN
      (SELECT appointment_id FROM dirty GROUP BY 1 HAVING count(*) > 1)""",
)
def duplicate_key_rows(spark, sf_dir):
    return check_unique(dirty(spark, sf_dir).select("row_id", "appointment_id"), "appointment_id")


@query(
    "unparseable_dates",
    f"""WITH {DIRTY} SELECT row_id, 'scheduled_day' AS "column", scheduled_day AS "value"
    FROM dirty WHERE scheduled_day = 'soon'""",
)
def unparseable_dates(spark, sf_dir):
    times = [replace(f, unique=False) for f in TABLE_FIELDS if f.time]
    return failure_report(dirty(spark, sf_dir), times, ["row_id"]).select("row_id", "column", "value")


@query(
    "verdict_per_file",
    f"""WITH {REPORT}, files AS (SELECT 'part-' || i AS file FROM range(5) t(i)),
    placed AS (SELECT row_id, 'part-' || (row_id % 4) AS file, appointment_id FROM dirty),
    cells AS (SELECT file, count(*) AS n FROM report JOIN placed USING (row_id)
      WHERE "check" <> 'unique' GROUP BY 1),
    dupes AS (SELECT file, sum(n) AS n FROM (SELECT file, appointment_id, count(*) AS n FROM placed
      GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1),
    present AS (SELECT DISTINCT file FROM placed)
    SELECT files.file, CAST(CASE WHEN present.file IS NULL THEN 1
        ELSE coalesce(cells.n, 0) + coalesce(dupes.n, 0) END AS BIGINT) AS problems,
      'INVALID' AS status, FALSE AS expected
    FROM files LEFT JOIN cells USING (file) LEFT JOIN dupes USING (file) LEFT JOIN present USING (file)""",
)
def verdict_per_file(spark, sf_dir):
    """Four files and an empty one; which file a row is in follows from its id."""
    part = F.concat(F.lit("part-"), (F.col("row_id") % 4).cast("string"))
    placed = dirty(spark, sf_dir).withColumn("file", part).drop("row_id")
    files = spark.range(5).select(F.concat(F.lit("part-"), F.col("id").cast("string")).alias("file"))
    return file_verdicts(placed, TABLE_FIELDS, files)


def request_rows(spark, sf_dir):
    """Dirty rows as scoring requests; some carry the label, which is refused."""
    label = F.when(F.col("row_id") % 53 == 0, F.col("no_show"))
    return dirty(spark, sf_dir).withColumn("no_show", label).drop("appointment_id").withColumnRenamed(
        "row_id", "request_id"
    )


REQUESTS = f"""{DIRTY}, reasons AS ({_cells(0)}
    UNION ALL SELECT row_id, 'no_show', 'extra_forbidden', no_show FROM dirty WHERE row_id % 53 = 0
    UNION ALL SELECT row_id, 'scheduled_day', 'on_or_before_outcome_day', scheduled_day FROM dirty
      WHERE scheduled_day <> 'soon' AND scheduled_day[:10] > appointment_day[:10])"""


@query(
    "refused_requests",
    f"""WITH {REQUESTS} SELECT row_id AS request_id, "column", "check", "value" FROM reasons""",
)
def refused_requests(spark, sf_dir):
    return judge(request_rows(spark, sf_dir)).select("request_id", F.inline("reasons"))


@query(
    "accepted_requests",
    f"""WITH {REQUESTS} SELECT row_id AS request_id, patient_id, age FROM dirty
    WHERE row_id NOT IN (SELECT row_id FROM reasons)""",
)
def accepted_requests(spark, sf_dir):
    accepted, _ = split_requests(
        request_rows(spark, sf_dir), REQUEST_FIELDS, forbidden=["no_show"]
    )
    return accepted.select("request_id", "patient_id", "age")


@query(
    "split_check",
    f"""WITH {CLEAN} SELECT split, count(*) AS n, count(DISTINCT no_show) AS classes,
      count(*) > 0 AND count(DISTINCT no_show) = 2 AS ok FROM cleaned GROUP BY 1""",
)
def split_check(spark, sf_dir):
    return check_split(rows(spark, sf_dir), "no_show", SPLIT.names)


@query(
    "split_size_check",
    f"""WITH {CLEAN}, recorded AS (SELECT CASE WHEN appointment_day <= TIMESTAMP '1999-12-31' THEN 'train'
        WHEN appointment_day <= TIMESTAMP '2000-12-31' THEN 'val' ELSE 'test' END AS split,
        count(*) AS recorded_n FROM appt GROUP BY 1),
      actual AS (SELECT split, count(*) AS actual_n FROM cleaned GROUP BY 1)
    SELECT split, recorded_n, actual_n, recorded_n IS NOT DISTINCT FROM actual_n AS same
    FROM recorded FULL JOIN actual USING (split)""",
)
def split_size_check(spark, sf_dir):
    """Sizes recorded before cleaning against sizes after it: all three differ."""
    raw = time_split(appointments(spark, sf_dir, place=False), SPLIT)
    return check_split_sizes(split_sizes(raw), split_sizes(rows(spark, sf_dir)))




LOADS = """loads AS (SELECT CAST(1 + o_orderkey % 4 AS INTEGER) AS load,
    CASE WHEN o_orderkey % 97 IN (1, 2) THEN o_orderkey - 1 WHEN o_orderkey % 113 <> 0 THEN o_orderkey END AS appointment_id FROM orders)"""


def loads(spark, sf_dir):
    """The appointments in four loads; some keys come again in a later one, some are NULL."""
    df = appointments(spark, sf_dir, place=False)
    key = F.col("appointment_id")
    again = F.when((key % 97).isin(1, 2), key - 1).when(key % 113 != 0, key)
    keyed = df.select((1 + key % 4).cast("int").alias("load"), again.alias("appointment_id"))
    return [keyed.where(F.col("load") == n).select("appointment_id") for n in (1, 2, 3, 4)]


def _registry(spark):
    return KeyRegistry(spark, shared_dir(spark, "key-registry"), "appointment_id", "bigint")


@query(
    "keys_loaded_before",
    f"""WITH {LOADS}, k AS (SELECT DISTINCT load, appointment_id FROM loads WHERE appointment_id IS NOT NULL)
    SELECT n.load, n.appointment_id, o.load AS earlier FROM k n JOIN k o ON o.appointment_id = n.appointment_id AND o.load < n.load
    WHERE n.load < 4 UNION ALL
    SELECT DISTINCT n.load, n.appointment_id, 4 FROM k n JOIN k o ON o.appointment_id = n.appointment_id AND o.load < n.load WHERE n.load = 4""",
)
def keys_loaded_before(spark, sf_dir):
    """Keys that an earlier load has too; before the fourth the three others are compacted into one."""
    registry, found = _registry(spark), []
    for number, part in enumerate(loads(spark, sf_dir), 1):
        if number == 4:
            registry.compact()
        again = registry.repeated(part)
        found.append(again.select(F.lit(number).alias("load"), "appointment_id", F.col("load").alias("earlier")))
        registry.add(part)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


@query(
    "key_filter_errors",
    f"""WITH {LOADS}, k AS (SELECT DISTINCT load, appointment_id FROM loads WHERE appointment_id IS NOT NULL)
    SELECT o.load, count(*) AS new_keys, TRUE AS rare FROM (SELECT DISTINCT load FROM k WHERE load < 4) o, k n
    WHERE n.load = 4 AND NOT EXISTS (SELECT 1 FROM k x WHERE x.load = o.load AND x.appointment_id = n.appointment_id) GROUP BY 1""",
)
def key_filter_errors(spark, sf_dir):
    """Of the keys that a load does not have, fewer than 2 % are looked up in vain."""
    registry = _registry(spark)
    *old, new = loads(spark, sf_dir)
    for part in old:
        registry.add(part)
    found = registry.false_positives(new)
    return found.select("load", "new_keys", (F.col("share") < 0.02).alias("rare"))
