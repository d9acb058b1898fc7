"""Cleaning and splitting by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import clip_upper, encode_target, normalize_place, parse_time
from riskspark.schema import ROLES, Roles, Split


def parse_times(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text, date and zone-less columns to UTC timestamps; columns already so stay as they are."""
    changed = {}
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            changed[name] = parse_time(F.col(name))
        elif not isinstance(kind, T.TimestampType):
            changed[name] = F.col(name).cast("timestamp")
    return df.withColumns(changed) if changed else df


def drop_invalid(df: DataFrame, roles: Roles = ROLES, age: str = "age") -> DataFrame:
    """Keep non-negative ages and rows known no later than the outcome day.

    Same-day rows stay. The outcome side is a bare column, so the comparison can prune files.
    """
    known_day = F.date_trunc("day", roles.known_at)
    return df.where((F.col(age) >= 0) & (known_day <= F.col(roles.outcome_at)))


def clean(df: DataFrame, roles: Roles = ROLES, handcap: str = "handcap") -> DataFrame:
    """Parse times, drop invalid rows, collapse handicap levels above 1."""
    parsed = parse_times(df, [roles.known_at, roles.outcome_at])
    return drop_invalid(parsed, roles).withColumn(handcap, clip_upper(F.col(handcap), 1))


def with_target(df: DataFrame, roles: Roles = ROLES, name: str = "target") -> DataFrame:
    return df.withColumn(name, encode_target(F.col(roles.label), roles.positive))


def split_name(outcome_at: Column, split: Split) -> Column:
    """Part of a row by its outcome time; the bounds are instants, not days."""
    train, val, test = split.names
    return (
        F.when(outcome_at <= F.lit(split.train_end).cast("timestamp"), train)
        .when(outcome_at <= F.lit(split.val_end).cast("timestamp"), val)
        .when(outcome_at.isNotNull(), test)
    )


def time_split(df: DataFrame, split: Split, roles: Roles = ROLES) -> DataFrame:
    """Add the ``split`` column; filter on it downstream."""
    return df.withColumn("split", split_name(F.col(roles.outcome_at), split))


def split_part(df: DataFrame, name: str, split: Split, roles: Roles = ROLES) -> DataFrame:
    """One part as a bare range filter on the outcome column, which reaches the scan."""
    at = F.col(roles.outcome_at)
    first, second = (F.lit(end).cast("timestamp") for end in (split.train_end, split.val_end))
    train, val, _ = split.names
    if name == train:
        return df.where(at <= first)
    if name == val:
        return df.where((at > first) & (at <= second))
    return df.where(at > second)


def entity_overlap(df: DataFrame, roles: Roles = ROLES, names=("train", "val", "test")) -> DataFrame:
    """Entities shared by each pair of parts, from one pass over the entities."""
    a, b, c = names
    flags = df.groupBy(roles.entity).agg(
        *[F.max(F.when(F.col("split") == n, 1).otherwise(0)).alias(n) for n in names]
    )
    known = flags.where(F.col(roles.entity).isNotNull())
    return known.agg(
        *[
            F.count_if((F.col(x) == 1) & (F.col(y) == 1)).alias(f"{x}_{y}")
            for x, y in ((a, b), (a, c), (b, c))
        ]
    )


def normalize_request(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Zone-less times are UTC, places upper case, handicap levels collapsed."""
    typed = parse_times(df, [roles.known_at, roles.outcome_at])
    return typed.withColumns(
        {
            "neighbourhood": normalize_place(F.col("neighbourhood")),
            "handcap": clip_upper(F.col("handcap"), 1),
        }
    )
