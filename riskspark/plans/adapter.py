"""The only place that knows the driver's tables: orders as appointments, events as requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.schema import Split
from riskspark.session import configure, utc_timestamps

SPLIT = Split("1999-12-31", "2000-12-31")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc_timestamps(configure(spark).read.parquet(f"{sf_dir}/{name}.parquet"))


def appointment_columns() -> list:
    """Orders columns to appointment columns, without the place name."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def every(n: int):
        return F.when(key % n == 0, 1).otherwise(0)

    return [
        (customer + 1).cast("double").alias("patient_id"),
        key.alias("appointment_id"),
        F.when(customer % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("o_orderdate").cast("timestamp").alias("scheduled_day"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval((key % 34 - 2).cast("int")))
        .alias("appointment_day"),
        (key % 130 - 3).cast("int").alias("age"),
        every(7).alias("scholarship"),
        every(5).alias("hipertension"),
        every(11).alias("diabetes"),
        every(13).alias("alcoholism"),
        (key % 6).cast("int").alias("handcap"),
        every(3).alias("sms_received"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("no_show"),
        ((key * 7919 % 1000) / F.lit(1000.0)).alias("score"),
    ]


def appointments(spark: SparkSession, sf_dir: str, place: bool = True) -> DataFrame:
    """All orders as raw appointments; ``place=False`` leaves out the two joins for the name."""
    orders = table(spark, sf_dir, "orders")
    if not place:
        return orders.select(appointment_columns())
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return placed.select(*appointment_columns(), F.col("n_name").alias("neighbourhood"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a request log: latency in ms, a score per request, calls of several rows."""
    return table(spark, sf_dir, "events").select(request_columns())


def request_columns() -> list:
    failed = F.col("event_type") == "error"
    return [
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("path"),
        F.when(failed, 500).otherwise(200).alias("status"),
        F.col("value").alias("latency_ms"),
        ((F.col("event_id") * 7919 % 1000) / F.lit(1000.0)).alias("score"),
        F.col("user_id").alias("caller"),
    ]
