"""History kept as a bucketed table that new days are added to.

Adding a delta costs what the delta holds. The table is bucketed by the entity's hash, so neither adding up its
days nor asking it shuffles the history; only the questions move.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions import day, ratio
from riskspark.operators.skew import lookup_join
from riskspark.schema import ROLES, Roles
from riskspark.session import shared_dir


def daily_outcomes(rows: DataFrame, target: str = "target", roles: Roles = ROLES) -> DataFrame:
    """(entity, day, n, k) of rows that have an entity, an outcome day and a label."""
    known = F.col(roles.entity).isNotNull() & F.col(roles.outcome_at).isNotNull() & F.col(target).isNotNull()
    days = rows.where(known).groupBy(F.col(roles.entity).alias("entity"), day(F.col(roles.outcome_at)).alias("day"))
    return days.agg(F.count(F.lit(1)).alias("n"), F.sum(target).cast("long").alias("k"))


class HistoryStore:
    """Per-day counts of every entity, as deltas in one bucketed table.

    Use at least as many buckets as shuffle partitions, or Spark may prefer to shuffle the table. Files
    lie in the shared folder; the table's name is known to the session's catalog.
    """

    def __init__(self, spark: SparkSession, buckets: int, target: str = "target", roles: Roles = ROLES) -> None:
        self.spark, self.buckets, self.target, self.roles = spark, buckets, target, roles
        self._fresh()

    def _fresh(self) -> None:
        self.table = f"history_{uuid.uuid4().hex[:12]}"
        self.path = shared_dir(self.spark, "history-store")
        self.deltas = 0

    def _write(self, days: DataFrame) -> None:
        dealt = days.withColumn("part", F.xxhash64("entity")).repartition(self.buckets, "part")  # one file per bucket
        writer = dealt.write.format("parquet").mode("append").bucketBy(self.buckets, "part").sortBy("part", "day")
        writer.option("path", self.path).saveAsTable(self.table)
        self.deltas += 1

    def append(self, rows: DataFrame) -> None:
        """Count further rows in. Rows of any day may come in any delta."""
        self._write(daily_outcomes(rows, self.target, self.roles))

    def state(self) -> DataFrame:
        """(entity, day, n, k) over all deltas, without an exchange."""
        return self._state().drop("part")

    def _state(self) -> DataFrame:
        days = self.spark.table(self.table).groupBy("part", "entity", "day")
        return days.agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    def compact(self) -> None:
        """One row per entity and day again, in a new table; the old files stay for readers that have begun."""
        summed, old = self.state(), self.table
        self._fresh()
        self._write(summed)
        self.spark.catalog.clearCache()
        self.spark.sql(f"DROP TABLE {old}")  # forgets the name; files of a table with a path are kept

    def by_part(self) -> DataFrame:
        """(part, days): the days of the entity behind a hash, bounded by the calendar; no exchange either.

        Hashes are what the table is bucketed by, as a floating-point key is not joined as it is stored.
        Entities of one hash share a row.
        """
        one = F.struct("entity", "day", "n", "k")
        return self._state().groupBy("part").agg(F.collect_list(one).alias("days"))

    def asof(self, df: DataFrame) -> DataFrame:
        """The rows with ``previous_appointments`` and ``previous_miss_rate``, as ``asof_history`` adds them."""
        entity, known_at = self.roles.entity, self.roles.known_at
        asked = (
            df.where(F.col(entity).isNotNull() & F.col(known_at).isNotNull())
            .groupBy(F.col(entity).alias("entity"), day(F.col(known_at)).alias("asked"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        zero = F.lit(0).cast("long")
        asked = asked.withColumn("part", F.xxhash64("entity"))
        own = F.filter("days", lambda d: (d["entity"] == F.col("entity")) & (d["day"] < F.col("asked")))
        found = asked.join(self.by_part().hint("merge"), "part").withColumn("_before", own)
        found = found.select(
            F.col("entity").alias(entity),
            F.col("asked").alias("_known_day"),
            "rows",
            F.aggregate("_before", zero, lambda s, d: s + d["n"]).alias("prev_n"),
            F.aggregate("_before", zero, lambda s, d: s + d["k"]).alias("prev_k"),
        )
        rows = df.withColumn("_known_day", day(F.col(known_at)))
        joined = lookup_join(rows, found, [entity, "_known_day"], weight="rows")
        return joined.select(
            *df.columns,
            F.coalesce(F.col("prev_n"), F.lit(0)).cast("double").alias("previous_appointments"),
            ratio(F.col("prev_k"), F.col("prev_n")).alias("previous_miss_rate"),
        )
