"""Drift between the train part and later parts."""

from pyspark.sql import functions as F

from riskspark.functions import normalize_label
from riskspark.operators import drift as D
from riskspark.operators.clean import split_part, with_target
from riskspark.operators.features import monitoring_features, numeric_features
from riskspark.operators.reference import binned_counts, fit_profile, psi_from_profile, psi_of_profile, read_profile, write_profile
from riskspark.plans.adapter import SPLIT, appointments, table
from riskspark.plans.monitoring import monitoring_report
from riskspark.plans.queries.base import CLEAN, curve_sql, query, r6, rows, stamp
from riskspark.schema import Policy
from riskspark.session import shared_dir
from riskspark.sources.writers import report_to_metrics, write_report

GENERATED = "2024-02-01 00:00:00"

# Numeric monitored columns of both sides, long, and the reference's distinct decile edges.
_NUMERIC = {
    "age": "age",
    "scholarship": "scholarship",
    "hipertension": "hipertension",
    "diabetes": "diabetes",
    "alcoholism": "alcoholism",
    "handcap": "handcap",
    "sms_received": "sms_received",
    "lead_time_days": "date_diff('day', scheduled_day, appointment_day)",
    "appointment_weekday": "(dayofweek(appointment_day) + 6) % 7",
}


def long_sql(columns: dict, kind: str, shifted: bool = False) -> str:
    source = "moved" if shifted else "cleaned"
    cells = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, CAST({text} AS {kind}) AS v, split FROM {source} WHERE split <> 'val'"
        for name, text in columns.items()
    )
    return f"SELECT feature, v, CASE WHEN split = 'train' THEN 'ref' ELSE 'cur' END AS side FROM ({cells})"


MOVED = """moved AS (SELECT * REPLACE (
    CASE WHEN split = 'test' THEN CASE WHEN age + 20 > 115 THEN 115 ELSE age + 20 END ELSE age END AS age,
    CASE WHEN split = 'test' THEN 1 ELSE sms_received END AS sms_received) FROM cleaned)"""

PSI = """psi AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM (
    SELECT feature, greatest(ref / CAST(sum(ref) OVER (PARTITION BY feature) AS DOUBLE), 1e-6) AS e,
      greatest(cur / CAST(sum(cur) OVER (PARTITION BY feature) AS DOUBLE), 1e-6) AS a FROM binned) GROUP BY 1)"""


def numeric_psi_sql(shifted: bool = False) -> str:
    probs = ", ".join(repr(i * 0.1) for i in range(11))
    return f"""{CLEAN}, {MOVED}, cells AS ({long_sql(_NUMERIC, 'DOUBLE', shifted)}),
  q AS (SELECT feature, list_distinct(quantile_cont(v, [{probs}])) AS es FROM cells WHERE side = 'ref' GROUP BY 1),
  edges AS (SELECT feature, unnest(es) AS e FROM q),
  inner_edges AS (SELECT feature, e FROM edges
    QUALIFY e > min(e) OVER (PARTITION BY feature) AND e < max(e) OVER (PARTITION BY feature)),
  vals AS (SELECT feature, v, count(*) FILTER (WHERE side = 'ref') AS ref,
    count(*) FILTER (WHERE side = 'cur') AS cur FROM cells GROUP BY 1, 2),
  placed AS (SELECT vals.feature, v, max(ref) AS ref, max(cur) AS cur, count(e) AS bin FROM vals
    LEFT JOIN inner_edges i ON i.feature = vals.feature AND i.e <= v GROUP BY 1, 2),
  binned AS (SELECT feature, bin, sum(ref) AS ref, sum(cur) AS cur FROM placed GROUP BY 1, 2), {PSI}"""


def sides(spark, sf_dir, shifted=False, place=False):
    """Train and test part; the place name costs two joins and is added only where it is used."""
    cleaned = rows(spark, sf_dir, place)
    ref, cur = (split_part(cleaned, part, SPLIT) for part in ("train", "test"))
    return ref, D.shift_covariates(cur) if shifted else cur


@query("psi_numeric", f"WITH {numeric_psi_sql()} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi_numeric(spark, sf_dir):
    ref, cur = (monitoring_features(s) for s in sides(spark, sf_dir))
    return r6(D.psi_numeric(ref, cur, numeric_features(ref)), "psi")


@query(
    "psi_after_covariate_shift",
    f"WITH {numeric_psi_sql(shifted=True)} SELECT feature, round(psi, 6) AS psi FROM psi",
)
def psi_after_covariate_shift(spark, sf_dir):
    """Age moves a lot; the group column was forced to 1, which quantile bins cannot see."""
    ref, cur = (monitoring_features(s) for s in sides(spark, sf_dir, shifted=True))
    return r6(D.psi_numeric(ref, cur, numeric_features(ref)), "psi")


_TEXT = {"gender": "gender", "neighbourhood": "CASE WHEN appointment_id % 9 <> 0 THEN neighbourhood END"}
TEXT_PSI = f"""{CLEAN}, cells AS ({long_sql(_TEXT, 'VARCHAR')}),
  binned AS (SELECT feature, coalesce(v, '<missing>') AS bin, count(*) FILTER (WHERE side = 'ref') AS ref,
    count(*) FILTER (WHERE side = 'cur') AS cur FROM cells GROUP BY 1, 2), {PSI}"""


def _text_sides(spark, sf_dir):
    hole = F.when(F.col("appointment_id") % 9 != 0, F.col("neighbourhood"))
    return [monitoring_features(s.withColumn("neighbourhood", hole)) for s in sides(spark, sf_dir, place=True)]


@query("psi_categorical", f"WITH {TEXT_PSI} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi_categorical(spark, sf_dir):
    ref, cur = _text_sides(spark, sf_dir)
    return r6(D.psi_categorical(ref, cur, ["gender", "neighbourhood"]), "psi")


def kept_profile(spark, ref, numeric, text):
    """Two stored versions of the profile, of which the second is read back."""
    path = shared_dir(spark, "profiles")
    write_profile(fit_profile(ref.limit(0), numeric, text, "1"), path)
    write_profile(fit_profile(ref, numeric, text, "2"), path)
    return read_profile(spark, path, "2")


@query("psi_from_profile", f"WITH {numeric_psi_sql(shifted=True)} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi_from_kept_profile(spark, sf_dir):
    """Shifted test rows against the stored bins of the train part."""
    ref, cur = (monitoring_features(s) for s in sides(spark, sf_dir, shifted=True))
    numeric = numeric_features(ref)
    return r6(psi_from_profile(kept_profile(spark, ref, numeric, []), cur.select(numeric)), "psi")


@query("psi_categorical_from_profile", f"WITH {TEXT_PSI} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi_categorical_from_profile(spark, sf_dir):
    ref, cur = _text_sides(spark, sf_dir)
    text = ["gender", "neighbourhood"]
    return r6(psi_from_profile(kept_profile(spark, ref, [], text), cur.select(text)), "psi")


QUARTERS = ["age", "lead_time_days"]
QUARTERS_SQL = f"""{CLEAN},
  cells AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({_NUMERIC[c]} AS DOUBLE) AS v, split, date_trunc('quarter', appointment_day) AS w FROM cleaned" for c in QUARTERS)}),
  q AS (SELECT feature, list_distinct(quantile_cont(v, [{", ".join(repr(i * 0.1) for i in range(11))}])) AS es FROM cells WHERE split = 'train' GROUP BY 1),
  edges AS (SELECT feature, unnest(es) AS e FROM q),
  inner_edges AS (SELECT feature, e FROM edges QUALIFY e > min(e) OVER (PARTITION BY feature) AND e < max(e) OVER (PARTITION BY feature)),
  vals AS (SELECT feature, v, split, w, count(*) AS n FROM cells GROUP BY ALL),
  placed AS (SELECT vals.feature, v, split, w, max(n) AS n, count(e) AS bin FROM vals
    LEFT JOIN inner_edges i ON i.feature = vals.feature AND i.e <= v GROUP BY 1, 2, 3, 4),
  ref AS (SELECT feature, bin, sum(n) AS ref FROM placed WHERE split = 'train' GROUP BY 1, 2),
  cur AS (SELECT feature, w, bin, sum(n) AS cur FROM placed WHERE split <> 'train' GROUP BY 1, 2, 3),
  spans AS (SELECT DISTINCT w FROM cur),
  both_sides AS (SELECT feature, w, bin, sum(ref) AS ref, sum(cur) AS cur FROM (
    SELECT feature, w, bin, ref, 0 AS cur FROM ref, spans UNION ALL SELECT feature, w, bin, 0, cur FROM cur) GROUP BY 1, 2, 3),
  psi AS (SELECT feature, w, sum((a - e) * ln(a / e)) AS psi FROM (SELECT feature, w,
      greatest(ref / CAST(sum(ref) OVER p AS DOUBLE), 1e-6) AS e, greatest(cur / CAST(sum(cur) OVER p AS DOUBLE), 1e-6) AS a
    FROM both_sides WINDOW p AS (PARTITION BY feature, w)) GROUP BY 1, 2)"""


@query(
    "psi_by_quarter",
    f"WITH {QUARTERS_SQL} SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS quarter, feature, round(psi, 6) AS psi FROM psi",
)
def psi_by_quarter(spark, sf_dir):
    """Each later quarter against the stored profile of the train part."""
    profile, later = _quarters(spark, sf_dir)
    counts = binned_counts(profile, later.select("quarter", *QUARTERS), [F.col("quarter")])
    return r6(stamp(psi_of_profile(profile, counts, ["quarter"]), "quarter"), "psi")


def _quarters(spark, sf_dir):
    """The stored profile, and later rows with their quarter."""
    cleaned = rows(spark, sf_dir)
    day = F.date_trunc("quarter", "appointment_day").alias("quarter")
    lead = F.datediff("appointment_day", "scheduled_day").cast("double").alias("lead_time_days")
    measured = cleaned.select("split", day, F.col("age").cast("double").alias("age"), lead, F.col("appointment_day").alias("at"))
    profile = kept_profile(spark, measured.where("split = 'train'"), QUARTERS, [])
    return profile, measured.where("split <> 'train'")


@query(
    "drift_summary",
    f"""WITH {numeric_psi_sql(shifted=True)}, p AS (SELECT feature, round(psi, 6) AS psi FROM psi)
    SELECT count(*) AS features, string_agg(feature, ',' ORDER BY feature) FILTER (WHERE psi >= 0.2) AS drifted,
      round(count(*) FILTER (WHERE psi >= 0.2) / CAST(count(*) AS DOUBLE), 6) AS drift_share,
      count(*) FILTER (WHERE psi >= 0.2) / CAST(count(*) AS DOUBLE) >= 0.2 AS alert FROM p""",
)
def drift_summary(spark, sf_dir):
    found = D.drift_summary(psi_after_covariate_shift(spark, sf_dir))
    return found.select("features", F.array_join("drifted", ",").alias("drifted"), "drift_share", "alert")


DISTANCE = f"""{CLEAN}, ncells AS ({long_sql(_NUMERIC, 'DOUBLE')}),
  vals AS (SELECT feature, v, count(*) FILTER (WHERE side = 'ref') AS ref,
    count(*) FILTER (WHERE side = 'cur') AS cur FROM ncells GROUP BY 1, 2),
  ecdf AS (SELECT feature, v, abs(sum(ref) OVER w / CAST(sum(ref) OVER p AS DOUBLE)
      - sum(cur) OVER w / CAST(sum(cur) OVER p AS DOUBLE)) AS gap,
      lead(v) OVER w AS nxt FROM vals
    WINDOW w AS (PARTITION BY feature ORDER BY v), p AS (PARTITION BY feature)),
  dev AS (SELECT feature, stddev_pop(v) AS d FROM ncells WHERE side = 'ref' GROUP BY 1),
  num AS (SELECT feature, max(gap) AS ks, sum(gap * (coalesce(nxt, v) - v)) / greatest(max(d), 0.001) AS distance
    FROM ecdf JOIN dev USING (feature) GROUP BY 1),
  cells AS ({long_sql(_TEXT, 'VARCHAR')}),
  cats AS (SELECT feature, coalesce(v, '<missing>') AS c, count(*) FILTER (WHERE side = 'ref') AS ref,
    count(*) FILTER (WHERE side = 'cur') AS cur FROM cells GROUP BY 1, 2),
  pq AS (SELECT feature, ref / CAST(sum(ref) OVER (PARTITION BY feature) AS DOUBLE) AS p,
    cur / CAST(sum(cur) OVER (PARTITION BY feature) AS DOUBLE) AS q FROM cats),
  txt AS (SELECT feature, sqrt(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2) AS distance FROM pq GROUP BY 1),
  dist AS (SELECT feature, ks, distance FROM num UNION ALL SELECT feature, NULL, distance FROM txt)"""


@query(
    "column_distance",
    f"""WITH {DISTANCE} SELECT feature, round(ks, 6) AS ks, round(distance, 6) AS distance,
      distance >= 0.05 AS drifted FROM dist""",
)
def column_distance(spark, sf_dir):
    ref, cur = _text_sides(spark, sf_dir)
    found = D.column_distance(ref, cur, numeric_features(ref), ["gender", "neighbourhood"], 0.05)
    return r6(found, "ks", "distance")


@query(
    "distance_summary",
    f"""WITH {DISTANCE} SELECT count(*) AS features,
      round(count(*) FILTER (WHERE distance >= 0.05) / CAST(count(*) AS DOUBLE), 6) AS drift_share,
      count(*) FILTER (WHERE distance >= 0.05) / CAST(count(*) AS DOUBLE) >= 0.2 AS alert FROM dist""",
)
def distance_summary(spark, sf_dir):
    return r6(D.distance_summary(column_distance(spark, sf_dir), 0.2), "drift_share")


@query(
    "prediction_drift",
    f"""WITH {CLEAN}, r AS (SELECT avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'train') AS a,
      avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'test') AS b FROM cleaned)
    SELECT round(a, 6) AS reference_rate, round(b, 6) AS current_rate, round(abs(b - a), 6) AS delta,
      abs(b - a) >= 0.1 AS alert FROM r""",
)
def prediction_drift(spark, sf_dir):
    ref, cur = sides(spark, sf_dir)
    return r6(D.prediction_drift(ref, cur, "score"), "reference_rate", "current_rate", "delta")


@query(
    "rate_per_group",
    f"""WITH {CLEAN} SELECT sms_received AS "group", count(*) AS n, round(avg(CAST(target AS DOUBLE)), 6) AS rate
    FROM cleaned GROUP BY 1""",
)
def rate_per_group(spark, sf_dir):
    return r6(D.subgroup_rate(rows(spark, sf_dir), "sms_received", "target"), "rate")


EFFECT = f"""{CLEAN}, e AS (SELECT
    avg(target) FILTER (WHERE split = 'train' AND sms_received = 1)
      - avg(target) FILTER (WHERE split = 'train' AND sms_received = 0) AS base,
    avg(CASE WHEN sms_received = 1 THEN 1 ELSE target END) FILTER (WHERE split = 'test' AND sms_received = 1)
      - avg(target) FILTER (WHERE split = 'test' AND sms_received = 0) AS now FROM cleaned)"""


def _changed(spark, sf_dir):
    """The test part with every outcome of the group turned positive."""
    ref, cur = sides(spark, sf_dir)
    return ref, with_target(D.shift_concept(cur))


@query(
    "group_effect_change",
    f"""WITH {EFFECT} SELECT round(base, 6) AS baseline_effect, round(now, 6) AS current_effect,
      round(abs(now - base), 6) AS delta FROM e""",
)
def group_effect_change(spark, sf_dir):
    ref, cur = _changed(spark, sf_dir)
    found = D.effect_delta(ref, cur, "sms_received", "target")
    return r6(found, "baseline_effect", "current_effect", "delta")


FEEDBACK = f"""{EFFECT}, fb AS (SELECT 1 AS g, CASE WHEN sms_received = 1 THEN 1 ELSE target END AS target,
    score, sms_received FROM cleaned WHERE split = 'test'), {curve_sql('fb', 'g')},
  auc AS (SELECT sum((n - pos) * (tp - pos / CAST(2 AS DOUBLE))) / (max(all_pos) * (max(all_n) - max(all_pos))) AS auc FROM cur),
  perf AS (SELECT count(*) AS labeled_rows, (SELECT auc FROM auc) AS roc_auc,
    count(*) FILTER (WHERE score >= 0.5 AND target = 1) / CAST(count(*) FILTER (WHERE score >= 0.5) AS DOUBLE) AS prec,
    count(*) FILTER (WHERE score >= 0.5 AND target = 1) / CAST(sum(target) AS DOUBLE) AS recall,
    count(*) FILTER (WHERE (score >= 0.5) = (target = 1)) / CAST(count(*) AS DOUBLE) AS accuracy,
    count(*) FILTER (WHERE score >= 0.5) / CAST(count(*) AS DOUBLE) AS rate,
    count(*) FILTER (WHERE sms_received = 0) AS n0, count(*) FILTER (WHERE sms_received = 1) AS n1 FROM fb)"""


def _performance(spark, sf_dir):
    ref, cur = _changed(spark, sf_dir)
    return ref, D.delayed_performance(cur, "target", "score", "sms_received")


@query(
    "delayed_performance",
    f"""WITH {FEEDBACK} SELECT labeled_rows, labeled_rows >= 200 AS enough_labeled_rows, round(roc_auc, 6) AS roc_auc,
      round(prec, 6) AS "precision", round(recall, 6) AS recall, round(accuracy, 6) AS accuracy,
      round(rate, 6) AS positive_prediction_rate, n0, n1 FROM perf""",
)
def delayed_performance(spark, sf_dir):
    _, found = _performance(spark, sf_dir)
    rounded = r6(found, "roc_auc", "precision", "recall", "accuracy", "positive_prediction_rate")
    return rounded.drop("rate0", "rate1")


@query(
    "performance_alert",
    f"""WITH {FEEDBACK} SELECT round(roc_auc, 6) AS roc_auc, labeled_rows >= 200 AND (roc_auc < 0.45
      OR 0.8 - roc_auc >= 0.05) AS performance_alert FROM perf""",
)
def performance_alert(spark, sf_dir):
    """With a lower limit than usual and a baseline set."""
    _, found = _performance(spark, sf_dir)
    alert = D.performance_alert(found, Policy(min_roc_auc=0.45, baseline_roc_auc=0.8))
    return r6(alert.select("roc_auc", "performance_alert"), "roc_auc")


CONCEPT = f"""{FEEDBACK}, concept AS (SELECT abs(now - base) AS delta, labeled_rows >= 200 AND roc_auc < 0.7 AS low,
    labeled_rows >= 200 AND least(n0, n1) >= 30 AND abs(now - base) >= 0.1 AS moved FROM perf, e)"""


@query(
    "concept_drift",
    f"""WITH {CONCEPT} SELECT round(delta, 6) AS effect_delta, low AS performance_alert,
      moved OR low AS concept_drift FROM concept""",
)
def concept_drift(spark, sf_dir):
    ref, found = _performance(spark, sf_dir)
    effect = D.effect_column(F.col("sms_received"), F.col("target"))
    row = D.concept_drift(found, with_target(ref).agg(effect).scalar())
    return r6(row.select("effect_delta", "performance_alert", "concept_drift"), "effect_delta")


_ALERTS = """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 10 = 0 END AS concept,
    o_orderkey % 3 = 0 AS data, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 7 = 0 END AS pred,
    ['waiting_for_labeled_feedback', 'not_enough_labels', 'enough_labels'][o_orderkey % 11 % 3 + 1] AS state FROM orders"""


@query(
    "decided_actions",
    f"""WITH a AS ({_ALERTS}) SELECT CASE WHEN coalesce(concept, FALSE) THEN 'RETRAIN'
      WHEN coalesce(data, FALSE) OR coalesce(pred, FALSE) THEN 'WATCH'
      WHEN state = 'not_enough_labels' THEN 'WAIT_FOR_LABELS' ELSE 'OK' END AS action, count(*) AS n FROM a GROUP BY 1""",
)
def decided_actions(spark, sf_dir):
    """Every combination of alerts, unknown ones among them."""
    key = F.col("o_orderkey")
    states = ["waiting_for_labeled_feedback", "not_enough_labels", "enough_labels"]
    state = F.get(F.array(*[F.lit(s) for s in states]), (key % 11 % 3).cast("int"))
    decided = D.action_columns(
        F.when(key % 2 == 0, key % 10 == 0),
        key % 3 == 0,
        F.when(key % 5 != 0, key % 7 == 0),
        state,
    )
    actions = table(spark, sf_dir, "orders").select(decided["action"].alias("action"))
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(
    "shifted_covariates",
    f"""WITH {CLEAN}, {MOVED} SELECT appointment_id, age, sms_received FROM moved WHERE split = 'test'""",
)
def shifted_covariates(spark, sf_dir):
    _, cur = sides(spark, sf_dir, shifted=True)
    return cur.select("appointment_id", "age", "sms_received")


@query(
    "shifted_concept",
    f"""WITH {CLEAN} SELECT appointment_id, CASE WHEN sms_received = 1 THEN 'Yes' ELSE no_show END AS no_show
    FROM cleaned WHERE split = 'test'""",
)
def shifted_concept(spark, sf_dir):
    _, cur = sides(spark, sf_dir)
    return D.shift_concept(cur).select("appointment_id", "no_show")


def prediction_and_outcome_logs(spark, sf_dir):
    """Scores at booking time, and outcomes known 12 hours into the appointment day.

    Rows booked after their day have an outcome before the prediction and do not match.
    """
    df = appointments(spark, sf_dir, place=False)
    predictions = df.select(
        "appointment_id", "patient_id", "score", F.col("scheduled_day").alias("predicted_at")
    )
    known = F.col("appointment_day") + F.expr("INTERVAL 12 HOURS")
    outcomes = df.select("appointment_id", "no_show", known.alias("known_at"))
    return predictions, outcomes


FEEDBACK_ROWS = f"""{CLEAN} SELECT appointment_id, score, CASE WHEN no_show = 'Yes' THEN 1 ELSE 0 END AS label,
    strftime(appointment_day + INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S') AS known_at FROM appt
    WHERE appointment_day + INTERVAL 12 HOUR >= scheduled_day"""


@query("feedback_rows", f"WITH {FEEDBACK_ROWS}")
def feedback_rows(spark, sf_dir):
    predictions, outcomes = prediction_and_outcome_logs(spark, sf_dir)
    found = D.build_feedback(predictions, outcomes, "appointment_id", "predicted_at", "known_at")
    label = normalize_label(F.col("no_show")).alias("label")
    return stamp(found, "known_at").select("appointment_id", "score", label, "known_at")


def _report(spark, sf_dir):
    ref, cur = sides(spark, sf_dir, shifted=True, place=True)
    feedback = D.shift_concept(split_part(rows(spark, sf_dir), "test", SPLIT))
    return monitoring_report(ref, cur, feedback, generated_at=GENERATED)


@query("monitoring_report")
def nested_report(spark, sf_dir):
    return _report(spark, sf_dir)


def _without_clean(sql: str) -> str:
    return sql.removeprefix(f"{CLEAN}, ")


_PLAIN_TEXT = {"gender": "gender", "neighbourhood": "neighbourhood"}
_TEXT_PART = f"""tcells AS ({long_sql(_PLAIN_TEXT, 'VARCHAR')}),
  tbinned AS (SELECT feature, coalesce(v, '<missing>') AS bin, count(*) FILTER (WHERE side = 'ref') AS ref,
    count(*) FILTER (WHERE side = 'cur') AS cur FROM tcells GROUP BY 1, 2),
  {PSI.replace('psi AS (', 'tpsi AS (', 1).replace('FROM binned', 'FROM tbinned')}"""

REPORT_METRICS = f"""{CONCEPT}, {_without_clean(numeric_psi_sql(shifted=True))}, {_TEXT_PART},
  every AS (SELECT feature, round(psi, 6) AS psi FROM psi UNION ALL SELECT feature, round(psi, 6) FROM tpsi),
  d AS (SELECT round(count(*) FILTER (WHERE psi >= 0.2) / CAST(count(*) AS DOUBLE), 6) AS share FROM every),
  rates AS (SELECT avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'train') AS a,
    avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'test') AS b FROM cleaned),
  one AS (SELECT * FROM d, rates, perf, concept),
  m AS (SELECT 'report_available' AS metric, 1.0 AS v
    UNION ALL SELECT 'data_drift_share', share FROM one
    UNION ALL SELECT 'concept_drift_suspected', CAST(moved OR low AS INTEGER) FROM one
    UNION ALL SELECT 'performance_alert', CAST(low AS INTEGER) FROM one
    UNION ALL SELECT 'retrain_recommended', CAST(moved OR low AS INTEGER) FROM one
    UNION ALL SELECT 'prediction_positive_rate', b FROM one
    UNION ALL SELECT 'prediction_drift_alert', CAST(abs(b - a) >= 0.1 AS INTEGER) FROM one
    UNION ALL SELECT 'effect_delta', delta FROM one
    UNION ALL SELECT 'last_run_timestamp_seconds', epoch(TIMESTAMP '{GENERATED}')
    UNION ALL SELECT 'labeled_rows', labeled_rows FROM one UNION ALL SELECT 'roc_auc', roc_auc FROM one
    UNION ALL SELECT 'precision', prec FROM one UNION ALL SELECT 'recall', recall FROM one
    UNION ALL SELECT 'accuracy', accuracy FROM one
    UNION ALL SELECT 'drift_share_threshold', 0.2 UNION ALL SELECT 'min_roc_auc_threshold', 0.7
    UNION ALL SELECT 'effect_delta_threshold', 0.1 UNION ALL SELECT 'p95_latency_threshold_seconds', 0.2
    UNION ALL SELECT 'error_rate_threshold', 0.01 UNION ALL SELECT 'min_labeled_rows_threshold', 200)
  SELECT metric, NULL AS label, round(CAST(v AS DOUBLE), 6) AS "value" FROM m
  UNION ALL SELECT 'feature_psi', feature, psi FROM every"""


@query("monitoring_report_as_metrics", f"WITH {REPORT_METRICS}")
def report_metrics(spark, sf_dir):
    """The report written as JSON, read back with its schema, and turned into metric rows."""
    report = _report(spark, sf_dir)
    path = shared_dir(spark, "report")
    write_report(report, path)
    return r6(report_to_metrics(spark.read.schema(report.schema).json(path)), "value")
