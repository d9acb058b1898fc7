"""Ranking metrics, thresholds, gates."""

from pyspark.sql import functions as F

from riskspark.operators import metrics as M
from riskspark.operators.gates import (
    gate_experiments,
    gate_preconditions,
    gate_relative,
    resolve_alias,
    score_parity,
)
from riskspark.operators.scoring import alert_count, prediction_columns
from riskspark.plans.adapter import table
from riskspark.plans.queries.base import (
    CLEAN,
    SCORES,
    curve_sql,
    experiment_scores,
    query,
    r6,
    rows,
)

CURVE = f"{CLEAN}, {curve_sql('cleaned', 'split')}"
COUNTS = f"""{CLEAN}, c AS (SELECT split,
    count(*) FILTER (WHERE score >= 0.5 AND target = 1) AS tp,
    count(*) FILTER (WHERE score >= 0.5 AND target = 0) AS fp,
    count(*) FILTER (WHERE score < 0.5 AND target = 1) AS fn,
    count(*) FILTER (WHERE score < 0.5 AND target = 0) AS tn FROM cleaned GROUP BY 1)"""


@query("confusion_by_split", f"WITH {COUNTS} SELECT split, tp, fp, fn, tn FROM c")
def confusion_by_split(spark, sf_dir):
    return M.confusion(rows(spark, sf_dir), "target", "score", 0.5, ["split"])


@query(
    "precision_recall_accuracy",
    f"""WITH {COUNTS} SELECT split, round(tp / CAST(tp + fp AS DOUBLE), 6) AS "precision",
      round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall,
      round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy FROM c""",
)
def precision_recall_accuracy(spark, sf_dir):
    found = M.with_rates(confusion_by_split(spark, sf_dir))
    names = ["precision", "recall", "accuracy"]
    return r6(found.select("split", *names), *names)


@query(
    "pr_curve",
    f"""WITH {CURVE} SELECT split, score AS threshold, CAST(tp AS BIGINT) AS tp,
      CAST(alerts - tp AS BIGINT) AS fp, round(tp / CAST(alerts AS DOUBLE), 6) AS "precision",
      round(tp / CAST(all_pos AS DOUBLE), 6) AS recall FROM cur""",
)
def pr_curve(spark, sf_dir):
    found = M.pr_curve(rows(spark, sf_dir), "target", "score", ["split"])
    return r6(found, "precision", "recall")


AP = "round(sum(pos * tp / CAST(alerts AS DOUBLE)) / max(all_pos), 6)"


@query("average_precision", f"WITH {CURVE} SELECT split, {AP} AS pr_auc FROM cur GROUP BY 1")
def average_precision(spark, sf_dir):
    return r6(M.average_precision(rows(spark, sf_dir), "target", "score", ["split"]), "pr_auc")


@query(
    "average_precision_overall",
    f"""WITH {CLEAN}, alltogether AS (SELECT 1 AS g, target, score FROM cleaned),
    {curve_sql('alltogether', 'g')} SELECT {AP} AS pr_auc FROM cur""",
)
def average_precision_overall(spark, sf_dir):
    return r6(M.average_precision(rows(spark, sf_dir), "target", "score"), "pr_auc")


@query(
    "average_precision_of_quality_labels",
    f"""WITH scored AS (SELECT 1 AS g, l.quality AS target, (d.n_chars % 100) / CAST(100 AS DOUBLE) AS score
      FROM labels l JOIN documents d USING (doc_id)), {curve_sql('scored', 'g')}
    SELECT {AP} AS pr_auc FROM cur""",
)
def average_precision_of_quality_labels(spark, sf_dir):
    """The same metric over another labelled table."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    score = (F.col("n_chars") % 100 / F.lit(100.0)).alias("score")
    docs = table(spark, sf_dir, "documents").select("doc_id", score)
    return r6(M.average_precision(labels.join(docs, "doc_id"), "target", "score"), "pr_auc")


@query(
    "roc_auc",
    f"""WITH {CURVE} SELECT split, round(sum((n - pos) * (tp - pos / CAST(2 AS DOUBLE)))
      / (max(all_pos) * (max(all_n) - max(all_pos))), 6) AS roc_auc FROM cur GROUP BY 1""",
)
def roc_auc(spark, sf_dir):
    return r6(M.roc_auc(rows(spark, sf_dir), "target", "score", ["split"]), "roc_auc")


THRESHOLD = f"""cand AS (SELECT split, score AS t, tp, alerts, all_pos FROM cur
    UNION ALL SELECT split, 0.0, sum(pos), sum(n), sum(pos) FROM pts GROUP BY 1
    UNION ALL SELECT split, 1.0, sum(CASE WHEN score >= 1 THEN pos ELSE 0 END),
      sum(CASE WHEN score >= 1 THEN n ELSE 0 END), sum(pos) FROM pts GROUP BY 1),
  rated AS (SELECT split, t, CASE WHEN alerts = 0 THEN 0 ELSE tp / CAST(alerts AS DOUBLE) END AS p,
    tp / CAST(all_pos AS DOUBLE) AS r FROM cand),
  chosen AS (SELECT split, t AS threshold FROM rated WHERE r >= 0.6
    QUALIFY row_number() OVER (PARTITION BY split ORDER BY p DESC, t DESC) = 1)"""


@query("chosen_threshold", f"WITH {CURVE}, {THRESHOLD} SELECT split, threshold FROM chosen")
def chosen_threshold(spark, sf_dir):
    return M.choose_threshold(rows(spark, sf_dir), "target", "score", 0.6, ["split"])


BY_SPLIT = """m AS (SELECT split, sum(pos * tp / CAST(alerts AS DOUBLE)) / max(all_pos) AS pr_auc,
    sum(CASE WHEN score >= 0.5 THEN pos ELSE 0 END) / CAST(max(all_pos) AS DOUBLE) AS recall,
    sum(CASE WHEN score >= 0.5 THEN pos ELSE 0 END)
      / CAST(sum(CASE WHEN score >= 0.5 THEN n ELSE 0 END) AS DOUBLE) AS prec
  FROM cur GROUP BY 1)"""


@query(
    "classification_metrics",
    f"""WITH {CURVE}, {BY_SPLIT} SELECT split, round(pr_auc, 6) AS pr_auc, round(recall, 6) AS recall,
      round(prec, 6) AS "precision", CAST(0.5 AS DOUBLE) AS threshold FROM m""",
)
def classification_metrics(spark, sf_dir):
    found = M.classification_metrics(rows(spark, sf_dir), "target", "score", 0.5, ["split"])
    return r6(found, "pr_auc", "recall", "precision")


@query(
    "metrics_by_split",
    f"""WITH {CURVE}, {BY_SPLIT} SELECT round(v.pr_auc, 6) AS val_pr_auc, round(v.recall, 6) AS val_recall,
      round(v.prec, 6) AS val_precision, CAST(0.5 AS DOUBLE) AS val_threshold,
      round(t.pr_auc, 6) AS test_pr_auc, round(t.recall, 6) AS test_recall,
      round(t.prec, 6) AS test_precision, CAST(0.5 AS DOUBLE) AS test_threshold
    FROM m v, m t WHERE v.split = 'val' AND t.split = 'test'""",
)
def metrics_by_split(spark, sf_dir):
    found = M.metrics_by_split(rows(spark, sf_dir), "target", "score", 0.5)
    return r6(found, *found.columns)


@query(
    "positive_rate",
    f"""WITH {CLEAN} SELECT split, round(avg(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END), 6) AS positive_rate
    FROM cleaned GROUP BY 1""",
)
def positive_rate(spark, sf_dir):
    return r6(M.positive_rate(rows(spark, sf_dir), "score", 0.5, ["split"]), "positive_rate")


@query(
    "outreach_cost",
    f"""WITH {COUNTS} SELECT split, tp + fp AS alerts, round((tp + fp) / CAST(tp AS DOUBLE), 6) AS alerts_per_hit,
      round((tp + fp) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS share_alerted,
      round((tp / CAST(tp + fp AS DOUBLE)) / ((tp + fn) / CAST(tp + fp + fn + tn AS DOUBLE)), 6) AS lift FROM c""",
)
def outreach_cost(spark, sf_dir):
    found = M.outreach_cost(rows(spark, sf_dir), "target", "score", 0.5, ["split"])
    return r6(found, "alerts_per_hit", "share_alerted", "lift")


@query(
    "hits_at_equal_budget",
    f"""WITH {SCORES}, top AS (SELECT * FROM scores
      QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY score DESC, appointment_id) <= 250),
    p AS (SELECT experiment, sum(target) AS p FROM scores GROUP BY 1)
    SELECT experiment, count(*) AS alerts, CAST(sum(target) AS BIGINT) AS hits,
      round(sum(target) / CAST(count(*) AS DOUBLE), 6) AS "precision",
      round(sum(target) / CAST(max(p) AS DOUBLE), 6) AS recall FROM top JOIN p USING (experiment) GROUP BY 1""",
)
def hits_at_equal_budget(spark, sf_dir):
    scores = experiment_scores(spark, sf_dir)
    found = M.compare_at_budget(scores, "target", "score", "appointment_id", budget=250)
    return r6(found, "precision", "recall")


@query(
    "alerts_at_equal_recall",
    f"""WITH {SCORES}, {curve_sql('scores', 'experiment')}
    SELECT experiment, CAST(min(alerts) AS BIGINT) AS alerts,
      round(min(tp) / CAST(min(alerts) AS DOUBLE), 6) AS "precision"
    FROM cur WHERE tp / CAST(all_pos AS DOUBLE) >= 0.5 GROUP BY 1""",
)
def alerts_at_equal_recall(spark, sf_dir):
    scores = experiment_scores(spark, sf_dir)
    return r6(M.compare_at_recall(scores, "target", "score", 0.5), "precision")


WIDE = f"""{SCORES}, es AS (SELECT experiment || '/' || split AS g, target, score FROM scores
    WHERE split <> 'train'), {curve_sql('es', 'g')},
  m AS (SELECT split_part(g, '/', 1) AS experiment, split_part(g, '/', 2) AS split,
    sum(pos * tp / CAST(alerts AS DOUBLE)) / max(all_pos) AS pr_auc,
    sum(CASE WHEN score >= 0.5 THEN pos ELSE 0 END) / CAST(max(all_pos) AS DOUBLE) AS recall
  FROM cur GROUP BY g),
  wide AS (SELECT v.experiment, v.pr_auc AS val_pr_auc, v.recall AS val_recall, t.pr_auc AS test_pr_auc,
    t.recall AS test_recall FROM m v JOIN m t USING (experiment) WHERE v.split = 'val' AND t.split = 'test')"""

_WIDE = ["val_pr_auc", "val_recall", "test_pr_auc", "test_recall"]


@query(
    "experiment_table",
    f"""WITH {WIDE} SELECT experiment, round(val_pr_auc, 6) AS val_pr_auc, round(val_recall, 6) AS val_recall,
      round(test_pr_auc, 6) AS test_pr_auc, round(test_recall, 6) AS test_recall FROM wide
    ORDER BY val_pr_auc DESC""",
)
def experiment_table(spark, sf_dir):
    scores = experiment_scores(spark, sf_dir)
    wide = M.metrics_by_split(scores, "target", "score", 0.5, by=["experiment"])
    long = wide.unpivot("experiment", _WIDE, "metric", "value")
    return r6(M.experiment_table(long, _WIDE), *_WIDE)


@query(
    "gate_on_recorded_metrics",
    f"""WITH {WIDE}, f AS (SELECT experiment,
      concat_ws('; ', CASE WHEN val_pr_auc < 0.298904 THEN 'PR-AUC below minimum' END,
        CASE WHEN val_recall < 0.6 THEN 'recall below minimum' END) AS failures FROM wide)
    SELECT experiment, failures, failures = '' AS passed FROM f""",
)
def gate_on_recorded_metrics(spark, sf_dir):
    found = gate_experiments(experiment_table(spark, sf_dir))
    return found.select("experiment", F.array_join("failures", "; ").alias("failures"), "passed")


@query(
    "gate_against_champion",
    f"""WITH {CLEAN}, v AS (SELECT target, score, (appointment_id * 104729 % 1000) / CAST(1000 AS DOUBLE) AS other
      FROM cleaned WHERE split = 'val'),
    r AS (SELECT count(*) AS rows, count(*) FILTER (WHERE target = 1 AND score >= 0.5)
        / CAST(sum(target) AS DOUBLE) AS a, count(*) FILTER (WHERE target = 1 AND other >= 0.4)
        / CAST(sum(target) AS DOUBLE) AS b FROM v)
    SELECT rows, round(a, 6) AS candidate_recall, round(b, 6) AS champion_recall,
      CASE WHEN a > b THEN '' ELSE 'recall not above the champion' END AS failures, a > b AS passed FROM r""",
)
def gate_against_champion(spark, sf_dir):
    other = F.col("appointment_id") * 104729 % 1000 / F.lit(1000.0)
    val = rows(spark, sf_dir).where("split = 'val'").withColumn("other", other)
    found = gate_relative(val, "target", "score", 0.5, "other", 0.4)
    found = found.withColumn("failures", F.array_join("failures", "; "))
    return r6(found, "candidate_recall", "champion_recall")


@query(
    "gate_preconditions",
    """WITH r AS (SELECT o_orderpriority AS version, CASE WHEN o_orderpriority LIKE '5%' THEN 'PENDING' ELSE 'READY' END AS status,
      CASE WHEN o_orderpriority LIKE '4%' THEN 'FAILED' ELSE 'FINISHED' END AS run_status, count(*) AS n FROM orders GROUP BY 1),
    f AS (SELECT version, concat_ws('; ', CASE WHEN status <> 'READY' THEN 'version not ready' END,
      CASE WHEN run_status <> 'FINISHED' THEN 'run not finished' END,
      CASE WHEN n % 2 = 1 THEN 'other data version' END,
      CASE WHEN version LIKE '1%' THEN 'invalid threshold' END,
      CASE WHEN version LIKE '2%' THEN 'threshold differs from evaluation' END,
      CASE WHEN version LIKE '3%' THEN 'recall not finite' END) AS failures FROM r)
    SELECT version, failures, failures = '' AS passed FROM f""",
)
def preconditions(spark, sf_dir):
    """One version record per order priority, each with its own planted fault."""
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("version")).agg(
        F.count(F.lit(1)).alias("n")
    )

    def priority(n):
        return F.col("version").startswith(str(n))

    limit = F.when(priority(1), 1.5).otherwise(0.5)
    records = counts.select(
        "version",
        F.when(priority(5), "PENDING").otherwise("READY").alias("status"),
        F.when(priority(4), "FAILED").otherwise("FINISHED").alias("run_status"),
        (F.col("n") % 2).alias("data_version"),
        F.lit(0).alias("gate_data_version"),
        limit.alias("threshold"),
        F.when(priority(2), 0.6).otherwise(limit).alias("recorded_threshold"),
        F.lit(0.4).alias("pr_auc"),
        F.when(priority(3), float("nan")).otherwise(0.7).alias("recall"),
    )
    found = gate_preconditions(records)
    return found.select("version", F.array_join("failures", "; ").alias("failures"), "passed")


@query(
    "alias_in_force",
    """SELECT o_orderpriority AS name, o_orderstatus AS alias, o_orderkey AS version,
      CASE WHEN o_orderkey % 3 = 0 THEN 0.5 ELSE (o_orderkey % 100) / CAST(100 AS DOUBLE) END AS threshold FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def alias_in_force(spark, sf_dir):
    """Orders as a log of alias moves; every third version has no threshold of its own."""
    key = F.col("o_orderkey")
    log = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("alias"),
        key.alias("version"),
        F.when(key % 3 != 0, key % 100 / F.lit(100.0)).alias("threshold"),
        F.col("o_orderdate").alias("ts"),
    )
    return resolve_alias(log)


def served_predictions(spark, sf_dir):
    """Predictions of the given score, as the scoring job writes them."""
    cleaned = rows(spark, sf_dir)
    columns = prediction_columns(F.col("score"), 0.5, "7", F.col("patient_id"))
    return cleaned.select("appointment_id", "split", *columns)


@query(
    "score_parity",
    f"""WITH {CLEAN}, p AS (SELECT round(score, 6) AS s, score >= 0.5 AS a,
      CASE WHEN appointment_id % 1000 = 1 THEN score + 0.25 ELSE score END AS p FROM cleaned)
    SELECT count(*) AS rows, round(max(abs(s - p)), 6) AS max_difference,
      count(*) FILTER (WHERE a <> (p >= 0.5)) AS alert_mismatches,
      CAST(0 AS BIGINT) AS missing_scores, CAST(0 AS BIGINT) AS unmatched,
      '7' AS versions, max(abs(s - p)) <= 1e-6 AND count(*) FILTER (WHERE a <> (p >= 0.5)) = 0 AS parity FROM p""",
)
def parity_of_scores(spark, sf_dir):
    """A few local scores are moved, so the check must fail."""
    moved = F.when(F.col("appointment_id") % 1000 == 1, F.col("score") + 0.25)
    local = rows(spark, sf_dir).select(
        "appointment_id", F.coalesce(moved, F.col("score")).alias("score")
    )
    found = score_parity(served_predictions(spark, sf_dir), local, "appointment_id", 0.5)
    return r6(found, "max_difference")


@query(
    "alert_count",
    f"""WITH {CLEAN} SELECT split, count(*) FILTER (WHERE score >= 0.5) AS n_alerts FROM cleaned GROUP BY 1""",
)
def alerts_in_batch(spark, sf_dir):
    return alert_count(served_predictions(spark, sf_dir), ("split",))
