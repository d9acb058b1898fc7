"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on (UTC) and what skew handling relies on (AQE)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(cores: str = "8", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskspark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master may go without that setting; it then gets one temporary folder
    per application.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_dirs.get(context.applicationId)
        if base is None:
            base = _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="riskspark-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utc_timestamps(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become TIMESTAMP (watermarks and window() need it); NaN becomes NULL."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampNTZType):
            column = column.cast("timestamp").alias(field.name)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column).alias(field.name)
        columns.append(column)
    return df.select(columns)
