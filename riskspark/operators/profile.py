"""Exploratory profile of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import count_rows, day


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(count_rows().alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share); NULL is not counted."""
    counts = df.where(_c(column).isNotNull()).groupBy(_c(column).alias("value")).agg(count_rows().alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def time_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, first, last) from one pass."""
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"), F.min(_c(c)).alias("first"), F.max(_c(c)).alias("last")
                )
                for c in columns
            ]
        ).alias("r")
    )
    return row.select(F.inline("r"))


def rows_per_day(df: DataFrame, time: str) -> DataFrame:
    return df.groupBy(day(_c(time)).alias("day")).agg(count_rows().alias("n")).orderBy("day")


def missing_cells(df: DataFrame) -> DataFrame:
    """(column, missing) and a ``<total>`` row, from one pass."""
    counts = [F.count_if(_c(c).isNull()) for c in df.columns]
    total = sum(counts[1:], counts[0])
    named = [(c, n) for c, n in zip(df.columns, counts)] + [("<total>", total)]
    row = df.agg(
        F.array(
            *[F.struct(F.lit(c).alias("column"), n.alias("missing")) for c, n in named]
        ).alias("m")
    )
    return row.select(F.inline("m"))


def duplicate_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """(duplicates): rows that repeat an earlier one, optionally without some columns.

    Copies collapse on the map side, so a large group of copies shuffles as few rows.
    """
    columns = [_c(c) for c in df.columns if c not in ignore]
    groups = df.groupBy(*columns).agg(count_rows().alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    """(duplicates): rows whose key occurred before."""
    return duplicate_rows(df.select(_c(key)))


def entity_profile(df: DataFrame, entity: str) -> DataFrame:
    """(entities, repeated, max_rows)."""
    counts = df.where(_c(entity).isNotNull()).groupBy(_c(entity)).agg(count_rows().alias("n"))
    return counts.agg(
        count_rows().alias("entities"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.max("n").alias("max_rows"),
    )


def fractional_ids(df: DataFrame, entity: str) -> DataFrame:
    return df.agg(F.count_if(_c(entity) % 1 != 0).alias("fractional"))


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One column per rule with the number of rows that break it."""
    return df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(count_rows().alias("n"))


def calendar_gaps(df: DataFrame, time: str) -> DataFrame:
    """(day): calendar days between the first and the last that have no row."""
    days = df.where(_c(time).isNotNull()).select(day(_c(time)).alias("day")).distinct()
    span = days.agg(F.sequence(F.min("day"), F.max("day")).alias("s"))
    return span.select(F.explode("s").alias("day")).join(days, "day", "left_anti")


def rate_by_month(df: DataFrame, time: str, target: str) -> DataFrame:
    """(month, n, rate)."""
    month = F.trunc(_c(time), "month").alias("month")
    return df.groupBy(month).agg(count_rows().alias("n"), F.avg(_c(target)).alias("rate"))
