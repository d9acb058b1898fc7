"""Leakage-safe entity history: what was known about an entity before a given day.

State is reduced to one row per (entity, day), so an entity is bounded by the calendar
however many rows it has, and the sorted window over an entity stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions import day, ratio
from riskspark.operators.skew import lookup_join
from riskspark.schema import ROLES, Roles


def fit_history(train: DataFrame, target: str = "target", roles: Roles = ROLES) -> DataFrame:
    """(entity, day, n, k, cum_n, cum_k): outcomes and positives per day and up to that day.

    Rows without an entity, an outcome day or a label are no history.
    """
    daily = (
        train.where(
            F.col(roles.entity).isNotNull()
            & F.col(roles.outcome_at).isNotNull()
            & F.col(target).isNotNull()
        )
        .groupBy(F.col(roles.entity).alias("entity"), day(F.col(roles.outcome_at)).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(target).cast("long").alias("k"))
    )
    so_far = (
        Window.partitionBy("entity")
        .orderBy("day")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumns({"cum_n": F.sum("n").over(so_far), "cum_k": F.sum("k").over(so_far)})


def asof_lookup(df: DataFrame, history: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """(entity, day, rows, prev_n, prev_k) for each (entity, known day) that ``df`` asks for."""
    asked = (
        df.where(F.col(roles.entity).isNotNull() & F.col(roles.known_at).isNotNull())
        .groupBy(F.col(roles.entity).alias("entity"), day(F.col(roles.known_at)).alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    zero = F.lit(0).cast("long")
    both = (
        history.select("entity", "day", "n", "k", zero.alias("rows"))
        .unionByName(asked.select("entity", "day", zero.alias("n"), zero.alias("k"), "rows"))
        .withColumn("at", F.unix_date("day"))
    )
    # Days strictly before: an outcome of the same day is not known yet.
    before = (
        Window.partitionBy("entity").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    )
    summed = both.select(
        "entity",
        "day",
        "rows",
        F.coalesce(F.sum("n").over(before), zero).alias("prev_n"),
        F.coalesce(F.sum("k").over(before), zero).alias("prev_k"),
    )
    return summed.where("rows > 0")


def history_of(history: DataFrame, batch: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """The history of a batch's entities."""
    wanted = batch.select(F.col(roles.entity).alias("entity")).distinct()
    return history.join(wanted, "entity", "left_semi")


def asof_history(df: DataFrame, history: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Add ``previous_appointments`` and ``previous_miss_rate`` to every row."""
    found = asof_lookup(df, history, roles).withColumnsRenamed(
        {"entity": roles.entity, "day": "_known_day"}
    )
    rows = df.withColumn("_known_day", day(F.col(roles.known_at)))
    joined = lookup_join(rows, found, [roles.entity, "_known_day"], weight="rows")
    count = F.coalesce(F.col("prev_n"), F.lit(0)).cast("double")
    return joined.select(
        *df.columns,
        count.alias("previous_appointments"),
        ratio(F.col("prev_k"), F.col("prev_n")).alias("previous_miss_rate"),
    )
