"""Streaming jobs over the driver's tables: the rows are written to a folder that is then
read as a stream until its end, and the written results are read back."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskspark.functions import normalize_label
from riskspark.operators.models import fit_logistic
from riskspark.operators.sketches import sketch_windows
from riskspark.plans.adapter import SPLIT, appointments, requests
from riskspark.plans.queries.base import APPT, CLEAN, REQ, query, r6, rows, stamp
from riskspark.operators.reference import binned_counts, psi_of_profile
from riskspark.plans.queries.drifting import FEEDBACK_ROWS, QUARTERS, QUARTERS_SQL, _quarters, prediction_and_outcome_logs
from riskspark.plans.queries.sourcing import HOURS
from riskspark.plans.queries.telemetry import rolled_up, rolled_up_sql
from riskspark.plans.queries.validating import REQUESTS, request_rows
from riskspark.plans.training import Scorer, prepare, scorer
from riskspark.session import configure, materialize, shared_dir
from riskspark.sources.readers import read_request_stream
from riskspark.streaming.feedback import feedback_stream, label_supply, labels_stream
from riskspark.streaming.history import history_stream
from riskspark.schema import PREDICTION_SCHEMA
from riskspark.streaming.scoring import Champion, Log, score_stream, score_stream_once, score_table
from riskspark.streaming.stateful import held_alerts_stream, keyed_state, spells, watchdog_stream
from riskspark.streaming.telemetry import (
    alerts_per_window_stream,
    append_to_table,
    score_histogram_stream,
    service_windows_stream,
)

_AT = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"
_LAST = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM req)"


def landed(df, purpose):
    """Write the rows to a folder and read it as a stream."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return read_request_stream(df.sparkSession, path, df.schema)


def arriving(spark, tables, stream_of, purpose, progress=None):
    """Land each table's slices one round after another, running the stream to its end after each.

    ``tables`` maps a name to the slices of that table; ``stream_of`` makes the stream from
    the streams of the tables. Every round is a restart from the checkpoint. ``progress`` gets the
    last progress of each round.
    """
    inboxes = {name: shared_dir(spark, f"{purpose}-{name}") for name in tables}
    path, checkpoint = shared_dir(spark, purpose), shared_dir(spark, f"{purpose}-checkpoint")
    with keyed_state(spark):
        for slices in zip(*tables.values(), strict=True):
            for name, rows_of in zip(tables, slices, strict=True):
                rows_of.write.mode("append").parquet(inboxes[name])
            schemas = {name: parts[0].schema for name, parts in tables.items()}
            stream = stream_of(**{n: read_request_stream(spark, inboxes[n], schemas[n]) for n in tables})
            run = append_to_table(stream, path, checkpoint)
            run.awaitTermination()
            if progress is not None:
                progress.append(run.lastProgress)
    return spark.read.schema(stream.schema).parquet(path)


def finished(stream, purpose):
    """Run the stream to its end into a table, and read the table."""
    spark = stream.sparkSession
    path = shared_dir(spark, purpose)
    append_to_table(stream, path, shared_dir(spark, f"{purpose}-checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("streamed_requests", f"WITH {REQ} SELECT path, status, count(*) AS n FROM req GROUP BY 1, 2")
def streamed_requests(spark, sf_dir):
    table = finished(landed(requests(spark, sf_dir), "requests"), "request-log")
    return table.groupBy("path", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "streamed_alerts_per_window",
    f"""WITH {REQ}, w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(CAST(5 * i AS INTEGER)) AS window_start,
      score >= 0.5 AS alert FROM req, range(12) t(i))
    SELECT {_AT}, alert, count(*) AS n FROM w WHERE window_start + INTERVAL 1 HOUR <= {_LAST} GROUP BY 1, 2""",
)
def streamed_alerts_per_window(spark, sf_dir):
    """Sliding hours that the watermark has closed."""
    log = requests(spark, sf_dir).withColumn("alert", F.col("score") >= 0.5)
    stream = alerts_per_window_stream(landed(log, "requests"))
    return stamp(finished(stream, "alert-windows"), "window_start")


@query(
    "streamed_score_histogram",
    f"""WITH {REQ}, {HOURS} SELECT {_AT}, CASE WHEN isinf(le) THEN 'inf' ELSE CAST(le AS VARCHAR) END AS le, n
    FROM hist WHERE window_start + INTERVAL 1 HOUR <= {_LAST}""",
)
def streamed_score_histogram(spark, sf_dir):
    stream = score_histogram_stream(landed(requests(spark, sf_dir), "requests"))
    found = stamp(finished(stream, "score-histogram"), "window_start")
    bound = F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("string"))
    return found.withColumn("le", bound)


@query(
    "streamed_service_windows",
    f"""WITH {REQ}, w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
      count(*) / CAST(300 AS DOUBLE) AS per_second,
      (count(*) FILTER (WHERE status >= 500) / CAST(300 AS DOUBLE)) / greatest(count(*) / CAST(300 AS DOUBLE), 0.001) AS error_rate
      FROM req GROUP BY 1)
    SELECT {_AT}, round(per_second, 6) AS per_second, round(error_rate, 6) AS error_rate FROM w
    WHERE window_start + INTERVAL 5 MINUTE <= {_LAST}""",
)
def streamed_service_windows(spark, sf_dir):
    stream = service_windows_stream(landed(requests(spark, sf_dir), "requests"))
    found = stamp(finished(stream, "service-windows"), "window_start")
    return r6(found.select("window_start", "per_second", "error_rate"), "per_second", "error_rate")


_DAYS_CLOSED = "ts < (SELECT date_trunc('day', max(ts) - INTERVAL 10 MINUTE) FROM req)"


@query("streamed_quantiles_rolled_up", f"WITH {REQ} {rolled_up_sql(_DAYS_CLOSED)}")
def streamed_quantiles_rolled_up(spark, sf_dir):
    """Hours and days from the five-minute sketches that a stream has left, up to the last closed day."""
    log = requests(spark, sf_dir)
    stream = sketch_windows(landed(log, "requests"), "latency_ms", by=["path"], late="10 minutes")
    kept = finished(stream, "sketches")
    closed = F.lit(log.agg(F.date_trunc("day", F.max("ts") - F.expr("INTERVAL 10 MINUTES"))).first()[0])
    return rolled_up(log.where(F.col("ts") < closed), kept.where(F.col("window_start") < closed))


@query("streamed_feedback", f"WITH {FEEDBACK_ROWS}")
def streamed_feedback(spark, sf_dir):
    """Prediction log and outcomes as two streams, matched up to 60 days; none of these outcomes is later."""
    predictions, outcomes = prediction_and_outcome_logs(spark, sf_dir)
    joined = feedback_stream(
        landed(predictions, "predictions"),
        landed(outcomes, "outcomes"),
        "appointment_id",
        "predicted_at",
        "known_at",
        max_lag="60 days",
    )
    label = normalize_label(F.col("no_show")).alias("label")
    found = stamp(finished(joined, "feedback"), "known_at")
    return found.select("appointment_id", "score", label, "known_at")


def _champion(spark, sf_dir, log_path):
    """Two fitted scorers saved as versions 1 and 2, the alias log pointing at 1; the first scorer too."""
    prepared, builder, preprocessor = prepare(appointments(spark, sf_dir), SPLIT)
    train = materialize(prepared.where("split = 'train'").select("features", "target"), "train")
    base = shared_dir(spark, "versions")
    first = scorer(builder, preprocessor, fit_logistic(train), 0.5, "1")
    first.save(f"{base}/1")
    scorer(builder, preprocessor, fit_logistic(train, c=0.01), 0.5, "2").save(f"{base}/2")
    move_alias(spark, log_path, "1", "2024-01-01")

    def load(version, threshold):
        return Scorer.load(spark, f"{base}/{version}", threshold, version)

    return Champion(lambda: spark.read.parquet(log_path), load, "risk"), first


def move_alias(spark, log_path, version, at):
    """Append one move to the alias log."""
    row = spark.range(1).select(
        F.lit("risk").alias("name"),
        F.lit("champion").alias("alias"),
        F.lit(version).alias("version"),
        F.lit(None).cast("double").alias("threshold"),
        F.lit(at).cast("timestamp").alias("ts"),
    )
    row.write.mode("append").parquet(log_path)


def _run_scoring(spark, source, champion, paths):
    """Score what has landed in ``source`` since the last run."""
    predictions, quarantine, checkpoint, path = paths
    stream = read_request_stream(spark, path, source.schema)
    score_stream(stream, champion, predictions, quarantine, checkpoint).awaitTermination()


def _scoring_paths(spark):
    return tuple(
        shared_dir(spark, name) for name in ("predictions", "quarantine", "scoring-checkpoint", "inbox")
    )


@query(
    "streamed_scores_equal_batch",
    f"""WITH {REQUESTS}, bad AS (SELECT DISTINCT row_id FROM reasons)
    SELECT (SELECT count(*) FROM dirty) - (SELECT count(*) FROM bad) AS scored, (SELECT count(*) FROM bad) AS refused,
      CAST(0 AS BIGINT) AS mismatches""",
)
def streamed_scores_equal_batch(spark, sf_dir):
    """Requests scored as a stream and as a table: counts and differing predictions."""
    source = request_rows(configure(spark), sf_dir)
    paths = _scoring_paths(spark)
    champion, first = _champion(spark, sf_dir, shared_dir(spark, "alias-log"))
    source.write.parquet(paths[3])
    _run_scoring(spark, source, champion, paths)
    streamed = spark.read.parquet(paths[0]).drop("batch")
    refused = spark.read.parquet(paths[1]).agg(F.count(F.lit(1))).scalar()
    batch, _ = score_table(source, first)
    names = ["patient_id", "score", "alert", "threshold", "model_version"]
    left = streamed.select("request_id", F.struct(*names).alias("s"))
    right = batch.select("request_id", F.struct(*names).alias("b"))
    same = F.col("s").eqNullSafe(F.col("b"))
    return left.join(right, "request_id", "full").agg(
        F.count("s").alias("scored"),
        F.max(refused).alias("refused"),
        F.count_if(~same).alias("mismatches"),
    )


@query(
    "scores_by_version",
    f"""WITH {REQUESTS}, good AS (SELECT row_id FROM dirty WHERE row_id NOT IN (SELECT row_id FROM reasons))
    SELECT CASE WHEN appointment_day < '1998-05-01' THEN '1' ELSE '2' END AS model_version, count(*) AS n
    FROM good JOIN dirty USING (row_id) GROUP BY 1""",
)
def scores_by_version(spark, sf_dir):
    """Requests for early days arrive before the alias moves to the second version, others after."""
    source = request_rows(configure(spark), sf_dir)
    paths = _scoring_paths(spark)
    log_path = shared_dir(spark, "alias-log")
    champion, _ = _champion(spark, sf_dir, log_path)
    early = F.col("appointment_day") < "1998-05-01"
    source.where(early).write.parquet(paths[3])
    _run_scoring(spark, source, champion, paths)
    move_alias(spark, log_path, "2", "2024-02-01")
    source.where(~early).write.mode("append").parquet(paths[3])
    _run_scoring(spark, source, champion, paths)
    scored = spark.read.parquet(paths[0])
    return scored.groupBy("model_version").agg(F.count(F.lit(1)).alias("n"))


def _rounds(df, at, days):
    """Slices of the rows by day, in the order of days."""
    bounds = [F.lit(d).cast("timestamp") for d in days]
    column = F.col(at)
    return (
        [df.where(column < bounds[0])]
        + [df.where((column >= a) & (column < b)) for a, b in zip(bounds, bounds[1:], strict=False)]
        + [df.where(column >= bounds[-1])]
    )


DAYS = ("1997-03-01", "1999-06-01")


def _grown(spark, sf_dir, requests_of):
    """Every request with the history that outcomes have told so far, in three rounds of days."""
    cleaned = rows(spark, sf_dir)
    outcomes = cleaned.select("patient_id", "appointment_day", "target")
    slices = {
        "outcomes": _rounds(outcomes, "appointment_day", DAYS),
        "requests": _rounds(requests_of(cleaned), "scheduled_day", DAYS),
    }
    return arriving(spark, slices, lambda outcomes, requests: history_stream(outcomes, requests), "history")


GROWN = f"""{CLEAN}, grown AS (SELECT a.appointment_id, count(t.appointment_id) AS n, coalesce(sum(t.target), 0) AS k
    FROM cleaned a LEFT JOIN cleaned t ON a.patient_id = t.patient_id
      AND CAST(t.appointment_day AS DATE) < CAST(a.scheduled_day AS DATE) GROUP BY 1)"""


@query(
    "streamed_history",
    f"""WITH {GROWN} SELECT appointment_id, CAST(n AS DOUBLE) AS previous_appointments,
      round(CASE WHEN n = 0 THEN 0 ELSE k / CAST(n AS DOUBLE) END, 6) AS previous_miss_rate FROM grown""",
)
def streamed_history(spark, sf_dir):
    """Outcomes and requests as streams in the order of days: each request sees all earlier days."""
    found = _grown(spark, sf_dir, lambda df: df.select("appointment_id", "patient_id", "scheduled_day"))
    return r6(
        found.select("appointment_id", "previous_appointments", "previous_miss_rate"), "previous_miss_rate"
    )


def error_series(spark, sf_dir):
    """Five-minute error rates of four groups of callers, and one row that says how late it is."""
    log = requests(spark, sf_dir).withColumn("team", F.col("caller") % 4)
    series = (
        log.groupBy("team", F.window("ts", "5 minutes")["start"].alias("window_start"))
        .agg(F.avg((F.col("status") >= 500).cast("double")).alias("error_rate"))
        .select("team", "window_start", "error_rate")
    )
    late = log.agg(
        F.lit(-1).cast("long").alias("team"),
        (F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("window_start"),
        F.lit(None).cast("double").alias("error_rate"),
    )
    return series.unionByName(late)


EVENT_DAYS = ("2024-01-11", "2024-01-21")


@query(
    "streamed_held_alerts",
    f"""WITH {REQ}, errs AS (SELECT caller % 4 AS team, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
        avg(CASE WHEN status >= 500 THEN 1.0 ELSE 0 END) AS error_rate FROM req GROUP BY 1, 2),
      o AS (SELECT team, window_start, error_rate > 0.01 AS hot, lag(error_rate > 0.01) OVER w AS was_hot, lag(window_start) OVER w AS before
        FROM errs WINDOW w AS (PARTITION BY team ORDER BY window_start)),
      s AS (SELECT team, window_start, sum(CASE WHEN was_hot AND epoch(window_start) - epoch(before) <= 7200 THEN 0 ELSE 1 END)
        OVER (PARTITION BY team ORDER BY window_start) AS spell FROM o WHERE hot),
      e AS (SELECT team, min(window_start) AS a, max(window_start) AS b FROM s GROUP BY team, spell)
    SELECT team, strftime(a, '%Y-%m-%d %H:%M:%S') AS started_at, strftime(a + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS fired_at,
      strftime(b, '%Y-%m-%d %H:%M:%S') AS ended_at FROM e WHERE epoch(b) - epoch(a) >= 600""",
)
def streamed_held_alerts(spark, sf_dir):
    """Error rate of a group of callers above 1 % for ten minutes, rows at most two hours apart."""
    slices = {"series": _rounds(error_series(spark, sf_dir), "window_start", EVENT_DAYS)}
    states = arriving(
        spark,
        slices,
        lambda series: held_alerts_stream(series, F.col("error_rate") > 0.01, 600, 7200, ["team"]),
        "held-alerts",
    )
    found = spells(states, ["team"], "firing", "resolved").toDF("team", "started_at", "fired_at", "ended_at")
    return stamp(found, "started_at", "fired_at", "ended_at")


@query(
    "streamed_silences",
    f"""WITH {REQ}, r AS (SELECT path, caller % 8 AS shard, ts, lead(ts) OVER (PARTITION BY path, caller % 8 ORDER BY ts) AS later,
        (SELECT max(ts) + INTERVAL 1 DAY FROM req) AS now FROM req)
    SELECT path, shard, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_seen, strftime(ts + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS silent_at,
      strftime(later, '%Y-%m-%d %H:%M:%S') AS back_at FROM r WHERE coalesce(later, now) > ts + INTERVAL 6 HOUR""",
)
def streamed_silences(spark, sf_dir):
    """Paths per group of callers from which nothing came for more than six hours, open ones included."""
    log = requests(spark, sf_dir).select("path", (F.col("caller") % 8).alias("shard"), "ts")
    late = log.agg(
        F.lit("now").alias("path"),
        F.lit(-1).cast("long").alias("shard"),
        (F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"),
    )
    states = arriving(
        spark,
        {"reports": _rounds(log.unionByName(late), "ts", EVENT_DAYS)},
        lambda reports: watchdog_stream(reports, 6 * 3600, ["path", "shard"], "ts", tick=F.col("path") == "now"),
        "watchdog",
    )
    found = spells(states, ["path", "shard"], "silent", "back")
    return stamp(found.toDF("path", "shard", "last_seen", "silent_at", "back_at"), "last_seen", "silent_at", "back_at")


LAGGED = f"""{APPT}, out AS (SELECT appointment_id, no_show, appointment_day + INTERVAL 12 HOUR AS known_at FROM appt WHERE appointment_id % 10 <> 0),
    states AS (SELECT p.appointment_id, p.scheduled_day AS predicted_at, o.known_at, CASE WHEN o.appointment_id IS NULL THEN 'expired' ELSE 'labeled' END AS label_state
      FROM appt p LEFT JOIN out o ON p.appointment_id = o.appointment_id AND o.known_at >= p.scheduled_day
        AND o.known_at <= p.scheduled_day + INTERVAL 20 DAY)"""


def label_states(spark, sf_dir):
    """Predictions with outcomes that come within 20 days; those of every tenth never come, others too late."""
    predictions, outcomes = prediction_and_outcome_logs(spark, sf_dir)
    outcomes = outcomes.where("appointment_id % 10 <> 0")
    # Rows that only say how late it is, one per stream, after all others. They need a key: rows
    # without one are left out before the watermark sees them.
    late = F.lit("2010-01-01").cast("timestamp")

    def with_tick(df, at):
        key = F.lit(-1).cast("long").alias("appointment_id")
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name not in (at, "appointment_id")]
        return df.unionByName(spark.range(1).select(late.alias(at), key, *others))

    slices = {
        "predictions": _rounds(with_tick(predictions, "predicted_at"), "predicted_at", DAYS),
        "outcomes": _rounds(with_tick(outcomes, "known_at"), "known_at", DAYS),
    }

    def joined(predictions, outcomes):
        return labels_stream(predictions, outcomes, "appointment_id", "predicted_at", "known_at", "20 days")

    return arriving(spark, slices, joined, "labels").where("appointment_id >= 0")


@query(
    "streamed_label_states",
    f"""WITH {LAGGED} SELECT appointment_id, label_state, strftime(known_at, '%Y-%m-%d %H:%M:%S') AS known_at FROM states""",
)
def streamed_label_states(spark, sf_dir):
    """Every prediction once: labelled, or expired because no outcome came within 20 days."""
    return stamp(label_states(spark, sf_dir), "known_at").select("appointment_id", "label_state", "known_at")


@query(
    "label_supply",
    f"""WITH {LAGGED}, m AS (SELECT time_bucket(INTERVAL 30 DAY, predicted_at, TIMESTAMP '1970-01-01') AS w, count(*) AS predictions,
        count(*) FILTER (WHERE label_state = 'labeled') AS labeled FROM states GROUP BY 1)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, predictions, labeled, predictions - labeled AS expired,
      CASE WHEN labeled >= 200 THEN 'enough_labels' ELSE 'not_enough_labels' END AS label_state,
      CASE WHEN labeled >= 200 THEN 'OK' ELSE 'WAIT_FOR_LABELS' END AS action FROM m""",
)
def streamed_label_supply(spark, sf_dir):
    """What thirty days of predictions have got in labels, and whether to wait for more."""
    return stamp(label_supply(label_states(spark, sf_dir), "predicted_at", "30 days"), "window_start")


@query(
    "streamed_psi_by_quarter",
    f"""WITH {QUARTERS_SQL} SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS quarter, feature, round(psi, 6) AS psi FROM psi
    WHERE w < (SELECT max(w) FROM psi)""",
)
def streamed_psi_by_quarter(spark, sf_dir):
    """Bins are counted as a stream against the stored profile; quarters count when the next has begun."""
    profile, later = _quarters(spark, sf_dir)
    stream = landed(later.select("at", *QUARTERS), "measured").withWatermark("at", "1 day")
    days = F.window("at", "1 day")
    counts = finished(binned_counts(profile, stream, [days.alias("day")]).select("day.start", "feature", "bin", "cur"), "bins")
    by_quarter = counts.groupBy(F.date_trunc("quarter", "start").alias("quarter"), "feature", "bin").agg(F.sum("cur").alias("cur"))
    last = later.agg(F.max("quarter")).first()[0]
    found = psi_of_profile(profile, by_quarter.where(F.col("quarter") < F.lit(last)), ["quarter"])
    return r6(stamp(found, "quarter"), "psi")


@query(
    "scores_published_once",
    f"""WITH {REQUESTS}, bad AS (SELECT DISTINCT row_id FROM reasons)
    SELECT (SELECT count(*) FROM dirty) - (SELECT count(*) FROM bad) AS scored,
      (SELECT count(*) FROM dirty) - (SELECT count(*) FROM bad) AS requests_scored, (SELECT count(*) FROM bad) AS refused""",
)
def scores_published_once(spark, sf_dir):
    """Every fifth request is sent twice, in one round or in two; rows and distinct requests in what is published."""
    source = request_rows(configure(spark), sf_dir).withColumn("received_at", F.lit("2024-01-01").cast("timestamp"))
    champion, _ = _champion(spark, sf_dir, shared_dir(spark, "alias-log"))
    log, inbox = Log(spark, shared_dir(spark, "published")), shared_dir(spark, "inbox")
    checkpoint = shared_dir(spark, "once-checkpoint")
    again = source.where("request_id % 5 = 0")
    first, second = source.where("request_id % 3 = 0"), source.where("request_id % 3 <> 0")
    for part in (first.unionByName(again.where("request_id % 3 = 0 AND request_id % 2 = 0")), second.unionByName(again.where("request_id % 2 = 1"))):
        part.write.mode("append").parquet(inbox)
        stream = read_request_stream(spark, inbox, source.schema)
        with keyed_state(spark):
            score_stream_once(stream, champion, log, checkpoint).awaitTermination()
    kept = StructType([StructField("request_id", source.schema["request_id"].dataType), *PREDICTION_SCHEMA.fields])
    scored = log.read("predictions", kept)
    refused = log.read("quarantine", StructType([kept["request_id"]]))
    return scored.agg(
        F.count(F.lit(1)).alias("scored"),
        F.countDistinct("request_id").alias("requests_scored"),
        F.max(refused.agg(F.count(F.lit(1))).scalar()).alias("refused"),
    )
