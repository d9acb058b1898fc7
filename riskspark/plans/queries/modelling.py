"""Preparation, fits and scoring.

Models learn the quality label of documents from their language, source and text measures. Every
query fits what it needs anew, with all trees, and scores every row.
"""

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskspark.operators import models as ML
from riskspark.operators import prep as P
from riskspark.operators.clean import split_part
from riskspark.operators.features import base_features
from riskspark.operators.gates import gate_size
from riskspark.operators.scoring import score_batch
from riskspark.plans.adapter import SPLIT, table
from riskspark.plans.queries.base import CLEAN, query, r6, rows
from riskspark.session import materialize, shared_dir

# Labelled rows that the fit of a model uses (its preparation takes all), at most about this many, by the hash of their id.
FIT_ROWS = 20_000
CATEGORICAL = ["lang", "source"]
NUMERIC = ["n_chars", "n_words", "n_lines", "upper_share", "digit_share"]
UPPER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def measured_documents(spark, sf_dir):
    """Documents with text measures, the part of their id, and their label where they have one."""
    text = F.coalesce("text", F.lit(""))
    size = F.char_length(text)

    def count(chars):
        return size - F.char_length(F.translate(text, chars, ""))

    measured = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        (count(" ") + 1).alias("n_words"),
        (count("\n") + 1).alias("n_lines"),
        (count(UPPER) / F.greatest(size, F.lit(1))).alias("upper_share"),
        (count(DIGITS) / F.greatest(size, F.lit(1))).alias("digit_share"),
        F.when(F.col("doc_id") % 10 < 6, "train").when(F.col("doc_id") % 10 < 8, "val").otherwise("test").alias("split"),
    )
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("int").alias("target"))
    return measured.join(labels, "doc_id", "left")


DOCS = """docs AS (
  SELECT doc_id, lang, source, n_chars,
    length(text) - length(replace(text, ' ', '')) + 1 AS n_words,
    length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines,
    (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) / CAST(greatest(length(text), 1) AS DOUBLE) AS upper_share,
    (length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) / CAST(greatest(length(text), 1) AS DOUBLE) AS digit_share,
    CASE WHEN doc_id % 10 < 6 THEN 'train' WHEN doc_id % 10 < 8 THEN 'val' ELSE 'test' END AS split, quality AS target
  FROM documents LEFT JOIN labels USING (doc_id)),
fitted AS (SELECT * FROM docs WHERE split = 'train' AND target IS NOT NULL),
stats AS (SELECT """ + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in NUMERIC
) + " FROM fitted)"


def for_fitting(train):
    """The labelled rows of a part, sampled by key beyond FIT_ROWS.

    A task for every 5000 of them: each level of each tree is a job over these few rows.
    """
    known = train.where(F.col("target").isNotNull())
    n = known.count()
    if n > FIT_ROWS:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < FIT_ROWS)
    return known.coalesce(1 + min(n, FIT_ROWS) // 5000)


def fit_preparation(measured):
    """Fill values, moments and categories of all labelled training rows."""
    known = split_of(measured, "train").where(F.col("target").isNotNull())
    return P.fit_preprocessor(known, CATEGORICAL, NUMERIC)


def prepared_documents(spark, sf_dir):
    """Vectors of all documents, written once, and the preparation that gave them."""
    measured = materialize(measured_documents(spark, sf_dir), "measured")
    preparation = fit_preparation(measured)
    vectors = preparation.transform(measured).select("doc_id", "features", "target", "split")
    path = shared_dir(spark, "prepared")
    vectors.write.parquet(path)
    return spark.read.parquet(path), preparation


def split_of(df, part):
    return df.where(F.col("split") == part)


def _holes(df):
    """Every seventh gender and every eleventh age blanked out."""
    key = F.col("appointment_id")
    return df.withColumns(
        {
            "gender": F.when(key % 7 != 0, F.col("gender")),
            "age": F.when(key % 11 != 0, F.col("age")),
        }
    )


HOLES = f"""{CLEAN}, holes AS (SELECT appointment_id, split, neighbourhood,
    CASE WHEN appointment_id % 7 <> 0 THEN gender END AS gender,
    CASE WHEN appointment_id % 11 <> 0 THEN age END AS age, sms_received FROM cleaned)"""


@query(
    "filled_with_mode",
    f"""WITH {HOLES}, m AS (SELECT gender AS g FROM holes WHERE split = 'train' AND gender IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT appointment_id, coalesce(gender, (SELECT g FROM m)) AS gender FROM holes""",
)
def filled_with_mode(spark, sf_dir):
    df = _holes(rows(spark, sf_dir))
    filled = P.impute_mode(split_part(df, "train", SPLIT), df, ["gender"])
    return filled.select("appointment_id", "gender")


@query(
    "filled_with_median",
    f"""WITH {HOLES} SELECT appointment_id, coalesce(CAST(age AS DOUBLE),
      (SELECT quantile_cont(age, 0.5) FROM holes WHERE split = 'train')) AS age FROM holes""",
)
def filled_with_median(spark, sf_dir):
    df = _holes(rows(spark, sf_dir))
    filled = P.impute_median(split_part(df, "train", SPLIT), df, ["age"])
    return filled.select("appointment_id", "age")


@query(
    "standardized",
    f"""WITH {CLEAN}, s AS (SELECT avg(age) AS ma, stddev_pop(age) AS da, avg(sms_received) AS ms,
      stddev_pop(sms_received) AS ds FROM cleaned WHERE split = 'train')
    SELECT appointment_id, round((age - ma) / da, 6) AS age, round((sms_received - ms) / ds, 6) AS sms_received,
      CAST(0 AS DOUBLE) AS constant FROM cleaned, s""",
)
def standardized(spark, sf_dir):
    df = rows(spark, sf_dir).withColumn("constant", F.lit(7))
    scaled = P.standardize(
        split_part(df, "train", SPLIT), df, ["age", "sms_received", "constant"]
    )
    return r6(scaled.select("appointment_id", "age", "sms_received", "constant"), "age", "sms_received")


@query(
    "one_hot_slots",
    f"""WITH {CLEAN}, w AS (SELECT split, CASE WHEN age <= 12 THEN 'child' WHEN age <= 18 THEN 'teen'
        WHEN age <= 35 THEN 'young_adult' WHEN age <= 55 THEN 'adult' WHEN age <= 75 THEN 'senior' ELSE 'elderly' END AS age_group FROM cleaned),
      cats AS (SELECT age_group, row_number() OVER (ORDER BY age_group) - 1 AS slot
        FROM (SELECT DISTINCT age_group FROM w WHERE split = 'train' AND age_group <> 'teen'))
    SELECT age_group, max(CAST(slot AS INTEGER)) AS slot, count(*) AS n FROM w LEFT JOIN cats USING (age_group) GROUP BY 1""",
)
def one_hot_slots(spark, sf_dir):
    """Fitted without teens, who then get all zeros (no slot)."""
    df = base_features(rows(spark, sf_dir)).select("age_group", "split")
    train = df.where("split = 'train' AND age_group <> 'teen'")
    hot = P.one_hot(["age_group"]).fit(train).transform(df)
    place = F.array_position(vector_to_array("age_group_hot"), 1.0) - 1
    slot = F.when(place >= 0, place).cast("int").alias("slot")
    return hot.groupBy("age_group", slot).agg(F.count(F.lit(1)).alias("n"))


@query(
    "balanced_weights",
    f"""WITH {CLEAN}, c AS (SELECT target, count(*) AS k FROM cleaned GROUP BY 1)
    SELECT target, count(*) AS n, round((SELECT count(*) FROM cleaned) / (2.0 * max(k)), 6) AS weight
    FROM cleaned JOIN c USING (target) GROUP BY 1""",
)
def balanced_weights(spark, sf_dir):
    found = P.balanced_weight(rows(spark, sf_dir), "target")
    by_class = found.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")
    )
    return r6(by_class, "weight")


@query(
    "assembled_vectors",
    f"""WITH {DOCS},
    langs AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS lang_slot FROM (SELECT DISTINCT lang FROM fitted)),
    sources AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS source_slot FROM (SELECT DISTINCT source FROM fitted))
    SELECT doc_id, CAST(lang_slot AS INTEGER) AS lang_slot, CAST(source_slot AS INTEGER) AS source_slot,
      {", ".join(f"round((({c}) - m_{c}) / d_{c}, 6) AS {c}" for c in NUMERIC)}
    FROM docs CROSS JOIN stats LEFT JOIN langs USING (lang) LEFT JOIN sources USING (source)""",
)
def assembled_vectors(spark, sf_dir):
    """Every document's vector, read back slot by slot."""
    vectors, _ = prepared_documents(spark, sf_dir)
    names, x = P.feature_names(vectors), vector_to_array("features")
    columns = [F.col("doc_id")]
    for c in CATEGORICAL:
        block = [i for i, n in enumerate(names) if n.startswith(f"{c}_filled_hot_")]
        place = F.array_position(F.slice(x, block[0] + 1, len(block)), 1.0)
        columns.append(F.when(place > 0, place - 1).cast("int").alias(f"{c}_slot"))
    columns += [F.round(x[names.index(f"{c}_scaled")], 6).alias(c) for c in NUMERIC]
    return vectors.select(columns)


def scores(vectors, model, version):
    """Prediction rows of all documents."""
    return score_batch(vectors, model, 0.5, version, entity="doc_id", keep=("doc_id",))


@query("logistic_coefficients")
def logistic_coefficients(spark, sf_dir):
    vectors, _ = prepared_documents(spark, sf_dir)
    model = ML.fit_logistic(for_fitting(split_of(vectors, "train")))
    pairs = [
        F.struct(F.lit(name).alias("feature"), F.lit(float(weight)).alias("coefficient"))
        for name, weight in zip(P.feature_names(vectors), model.coefficients.toArray())
    ]
    return spark.range(1).select(F.inline(F.array(*pairs)))


@query("logistic_scores")
def logistic_scores(spark, sf_dir):
    vectors, _ = prepared_documents(spark, sf_dir)
    return scores(vectors, ML.fit_logistic(for_fitting(split_of(vectors, "train"))), "1")


@query(
    "logistic_score_rows",
    "SELECT doc_id, CAST(0.5 AS DOUBLE) AS threshold, '1' AS model_version, TRUE AS in_range, TRUE AS alert_agrees FROM documents",
)
def logistic_score_rows(spark, sf_dir):
    """What is exact about scores: one per document, between 0 and 1, with the alert it asks for."""
    found = logistic_scores(spark, sf_dir)
    far = F.abs(F.col("score") - F.col("threshold")) > 1e-6  # alerts look at the unrounded score
    agrees = ~far | (F.col("alert") == (F.col("score") >= F.col("threshold")))
    return found.select(
        "doc_id", "threshold", "model_version", F.col("score").between(0, 1).alias("in_range"), agrees.alias("alert_agrees")
    )


@query("boosted_scores")
def boosted_scores(spark, sf_dir):
    vectors, _ = prepared_documents(spark, sf_dir)
    return scores(vectors, ML.fit_boosted(for_fitting(split_of(vectors, "train"))), "2")


@query("boosted_tuned_scores")
def boosted_tuned_scores(spark, sf_dir):
    vectors, _ = prepared_documents(spark, sf_dir)
    return scores(vectors, ML.fit_boosted_tuned(for_fitting(split_of(vectors, "train"))), "3")


@query("experiment_metrics")
def experiment_metrics(spark, sf_dir):
    """All three experiments, fitted, scored and evaluated on labelled documents."""
    vectors, _ = prepared_documents(spark, sf_dir)
    train = for_fitting(split_of(vectors, "train"))
    rest = vectors.where((F.col("split") != "train") & F.col("target").isNotNull())
    metrics, _ = ML.run_experiments(train.unionByName(rest), ML.default_experiments())
    return metrics


@query(
    "logistic_importance",
    f"""WITH {DOCS}, v AS (SELECT * FROM docs CROSS JOIN stats WHERE split = 'val' AND target IS NOT NULL),
    hot AS (
      SELECT 'lang_filled_hot_' || lang AS feature, count(*) FILTER (WHERE v.lang = f.lang) / CAST(count(*) AS DOUBLE) AS p
      FROM (SELECT DISTINCT lang FROM fitted) f CROSS JOIN v GROUP BY f.lang
      UNION ALL
      SELECT 'source_filled_hot_' || f.source, count(*) FILTER (WHERE v.source = f.source) / CAST(count(*) AS DOUBLE)
      FROM (SELECT DISTINCT source FROM fitted) f CROSS JOIN v GROUP BY f.source)
    SELECT feature, round(2 * p * (1 - p), 6) AS deviation, TRUE AS agrees FROM hot
    {" ".join(f"UNION ALL SELECT '{c}_scaled', round(avg(abs({c} - (SELECT avg({c}) FROM v)) / d_{c}), 6), TRUE FROM v" for c in NUMERIC)}""".replace(
        "'lang_filled_hot_' || lang AS", "'lang_filled_hot_' || f.lang AS"
    ),
)
def logistic_importance(spark, sf_dir):
    """Mean deviation of every slot over all labelled validation rows, and whether the importance is
    that times the fitted coefficient."""
    vectors, _ = prepared_documents(spark, sf_dir)
    model = ML.fit_logistic(for_fitting(split_of(vectors, "train")))
    val = split_of(vectors, "val").where(F.col("target").isNotNull())
    weights = dict(zip(P.feature_names(vectors), model.coefficients.toArray()))
    size = F.create_map(*[F.lit(v) for n, w in weights.items() for v in (n, abs(float(w)))])
    found = ML.linear_importance(val, model)
    agrees = F.abs(F.col("importance") - size[F.col("feature")] * F.col("deviation")) < 1e-9
    return r6(found.select("feature", "deviation", agrees.alias("agrees")), "deviation")


@query("boosted_importance")
def boosted_importance(spark, sf_dir):
    vectors, _ = prepared_documents(spark, sf_dir)
    model = ML.fit_boosted(for_fitting(split_of(vectors, "train")))
    val = split_of(vectors, "val").where(F.col("target").isNotNull())
    return ML.permutation_importance(val, model, "doc_id")


def fitted_pipeline(spark, sf_dir):
    """Measured documents, and preparation and logistic model as one pipeline."""
    measured = materialize(measured_documents(spark, sf_dir), "measured")
    train = for_fitting(split_of(measured, "train"))
    preparation = fit_preparation(measured)
    model = ML.fit_logistic(preparation.transform(train))
    return measured, PipelineModel([*preparation.stages, model])


@query(
    "reloaded_model_scores",
    "SELECT count(*) AS rows, CAST(0 AS DOUBLE) AS max_difference FROM documents",
)
def reloaded_model_scores(spark, sf_dir):
    """Largest score difference of a saved and reloaded model, over all documents."""
    measured, model = fitted_pipeline(spark, sf_dir)
    return ML.save_load_check(model, measured, shared_dir(spark, "model"))


@query("gate_on_model_size")
def gate_on_model_size(spark, sf_dir):
    path = shared_dir(spark, "sized-model")
    fitted_pipeline(spark, sf_dir)[1].write().save(path)
    return gate_size(ML.artifact_size_mb(spark, path))
