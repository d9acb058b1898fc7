"""Reading raw tables, results, load-test statistics, metric scrapes and request streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.validate import coerce_types
from riskspark.schema import RAW_NAMES, TABLE_FIELDS, Field

# Words that mean "missing" in a raw table.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_raw(spark: SparkSession, path: str | list[str], format: str = "csv") -> DataFrame:
    """A raw table with all columns as text, missing words as NULL, and its own column names.

    Types are cast by validation, so that a bad cell is reported instead of lost.
    """
    if format == "csv":
        table = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    else:
        table = spark.read.format(format).load(path)
    return table.select([_text_or_null(f) for f in table.schema.fields])


def _text_or_null(field: T.StructField):
    text = F.col(f"`{field.name}`").cast("string")
    return F.when(~text.isin(MISSING_WORDS), text).alias(field.name)


def ingest(raw: DataFrame, fields: Sequence[Field] = TABLE_FIELDS) -> DataFrame:
    """Plain column names and declared types; text that does not fit becomes NULL."""
    renamed = raw.withColumnsRenamed({k: v for k, v in RAW_NAMES.items() if k in raw.columns})
    return coerce_types(renamed, fields)


def file_digest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, sha256) of file contents; a file must stay below 2 GB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), F.sha2("content", 256).alias("sha256"))


def verify_digest(spark: SparkSession, path: str, expected: str) -> str:
    """The digest of one file; stops if it is not the expected version of the data."""
    found = file_digest(spark, path).first()["sha256"]
    if found != expected:
        raise ValueError(f"data version mismatch: {found} is not {expected}")
    return found


def table_fingerprint(df: DataFrame) -> DataFrame:
    """(rows, xor_hash, sum_hash): a content version of any table, whatever its order or files."""
    hashed = df.select(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).alias("h"))
    return hashed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("xor_hash"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum_hash"),
    )


RESULTS_SCHEMA = T.StructType(
    [
        T.StructField("selected_model", T.StringType()),
        T.StructField("selected_threshold", T.DoubleType()),
        T.StructField("data_sha256", T.StringType()),
        T.StructField(
            "experiments",
            T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())),
        ),
    ]
)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Experiment results to (selected_model, selected_threshold, data_sha256, experiment, metric, value)."""
    head = ["selected_model", "selected_threshold", "data_sha256"]
    raw = spark.read.schema(RESULTS_SCHEMA).json(path, multiLine=True)
    per_experiment = raw.select(*head, F.explode("experiments").alias("experiment", "metrics"))
    return per_experiment.select(*head, "experiment", F.explode("metrics").alias("metric", "value"))


def read_stats(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Load-test statistics, one row per run and endpoint.

    The run is the name of the file, or of its folder, before ``_stats.csv``. Missing numbers
    are NULL.
    """
    raw = spark.read.option("header", True).csv(path)
    name = r"([^/]+?)(?:_stats)?\.csv(?:/[^/]*)?$"
    run = F.regexp_extract(F.col("_metadata.file_path"), name, 1)
    total, failed = (F.col(f"`{c}`").try_cast("long") for c in ("Request Count", "Failure Count"))
    return raw.select(
        run.alias("run"),
        F.trim(F.concat_ws(" ", "Type", "Name")).alias("endpoint"),
        total.alias("requests"),
        failed.alias("failures"),
        F.col("`Requests/s`").try_cast("double").alias("rps"),
        *[F.col(f"`{q}%`").try_cast("double").alias(f"p{q}_ms") for q in (50, 95, 99)],
        F.coalesce(F.try_divide(failed.cast("double"), total.cast("double")), F.lit(0.0)).alias(
            "error_rate"
        ),
    )


def parse_scrape(lines: DataFrame, line: str = "value") -> DataFrame:
    """Metric lines to (name, labels, le, value); comment lines are skipped."""
    text = F.trim(F.col(line))
    pattern = r"^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{(.*)\})?\s+(\S+)"
    pair = F.lit(r'([A-Za-z_]\w*)="((?:[^"\\]|\\.)*)"')
    body = F.regexp_extract(text, pattern, 2)
    labels = F.map_from_arrays(
        F.regexp_extract_all(body, pair, F.lit(1)), F.regexp_extract_all(body, pair, F.lit(2))
    )
    parsed = lines.where(text.rlike(pattern)).select(
        F.regexp_extract(text, pattern, 1).alias("name"),
        labels.alias("labels"),
        F.regexp_extract(text, pattern, 3).try_cast("double").alias("value"),
    )
    bound = F.try_element_at("labels", F.lit("le")).try_cast("double")
    return parsed.select(
        "name", F.map_filter("labels", lambda k, _: k != "le").alias("labels"), bound.alias("le"), "value"
    )


def read_scrape(spark: SparkSession, path: str) -> DataFrame:
    return parse_scrape(spark.read.text(path))


def read_request_stream(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", max_files: int = 100
) -> DataFrame:
    """Requests as they arrive in a folder, at most ``max_files`` files per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.format(format).load(path)
