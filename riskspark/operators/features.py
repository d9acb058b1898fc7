"""Feature columns: the training/scoring set and the looser monitoring set."""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import (
    MISSING,
    age_group,
    lead_time_days,
    lead_time_fraction,
    parse_time,
    weekday_name,
    weekday_number,
)
from riskspark.operators.clean import parse_times
from riskspark.operators.history import asof_history, fit_history, history_of
from riskspark.schema import ROLES, Roles

# The model's input columns.
CATEGORICAL = ["gender", "neighbourhood", "appointment_weekday", "age_group"]
NUMERIC = [
    "age",
    "scholarship",
    "hipertension",
    "diabetes",
    "alcoholism",
    "handcap",
    "sms_received",
    "lead_time_days",
    "previous_appointments",
    "previous_miss_rate",
]

# Columns that drift monitoring looks at, and those it treats as text.
MONITORED = [
    "age",
    "gender",
    "neighbourhood",
    "scholarship",
    "hipertension",
    "hypertension",
    "diabetes",
    "alcoholism",
    "handcap",
    "handicap",
    "sms_received",
    "lead_time_days",
    "appointment_weekday",
    "age_group",
]
MONITORED_TEXT = ["neighbourhood", "gender", "age_group"]


def base_features(df: DataFrame, roles: Roles = ROLES, age: str = "age") -> DataFrame:
    """Add lead_time_days, appointment_weekday and age_group."""
    known, outcome = F.col(roles.known_at), F.col(roles.outcome_at)
    return df.withColumns(
        {
            "lead_time_days": lead_time_days(known, outcome),
            "appointment_weekday": weekday_name(outcome),
            "age_group": age_group(F.col(age)),
        }
    )


def monitoring_features(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """The monitored columns that exist: text filled, the rest numeric or NULL.

    Lead time is the exact, unclipped difference and the weekday a number, unlike the
    model's features. Names match without regard to case.
    """
    have = {name.lower(): name for name in df.columns}

    def time(name: str):
        column = F.col(f"`{have[name]}`")
        if isinstance(df.schema[have[name]].dataType, T.StringType):
            return parse_time(column)
        return column.cast("timestamp")

    known, outcome = roles.known_at.lower(), roles.outcome_at.lower()
    known = known if known in have else known.replace("_", "")
    outcome = outcome if outcome in have else outcome.replace("_", "")
    derived = {}
    if "lead_time_days" not in have and known in have and outcome in have:
        derived["lead_time_days"] = lead_time_fraction(time(known), time(outcome))
    if "appointment_weekday" not in have and outcome in have:
        derived["appointment_weekday"] = weekday_number(time(outcome))

    columns = []
    for name in MONITORED:
        if name in derived:
            source = derived[name]
        elif name in have:
            source = F.col(f"`{have[name]}`")
        else:
            continue
        if name in MONITORED_TEXT:
            columns.append(F.coalesce(source.cast("string"), F.lit(MISSING)).alias(name))
        else:
            columns.append(source.try_cast("double").alias(name))
    if not columns:
        raise ValueError(f"none of the monitored columns found in {df.columns}")
    return df.select(columns)


def numeric_features(df: DataFrame) -> list[str]:
    return [n for n in df.columns if n not in MONITORED_TEXT]


class FeatureBuilder(Estimator):
    """Learns entity history from the training rows."""

    def __init__(self, roles: Roles = ROLES, target: str = "target"):
        super().__init__()
        self.roles, self.target = roles, target

    def _fit(self, train: DataFrame) -> FeatureBuilderModel:
        parsed = parse_times(train, [self.roles.known_at, self.roles.outcome_at])
        return FeatureBuilderModel(fit_history(parsed, self.target, self.roles), self.roles)


class FeatureBuilderModel(Model):
    """Adds base features and as-of history; the same object serves training and scoring.

    Rows that already carry both history columns, as those of ``history_stream`` do, keep them.
    """

    def __init__(self, history: DataFrame, roles: Roles = ROLES, prune_history: bool = False):
        super().__init__()
        self.history, self.roles, self.prune_history = history, roles, prune_history

    def _transform(self, df: DataFrame) -> DataFrame:
        parsed = parse_times(df, [self.roles.known_at, self.roles.outcome_at])
        if {"previous_appointments", "previous_miss_rate"} <= set(df.columns):
            return base_features(parsed, self.roles)  # the history came with the rows
        history = self.history
        if self.prune_history:
            history = history_of(history, parsed, self.roles)
        return base_features(asof_history(parsed, history, self.roles), self.roles)

    def save(self, path: str) -> None:
        """History as a table in entity order, column roles as one JSON line."""
        ordered = self.history.repartitionByRange("entity").sortWithinPartitions("entity", "day")
        ordered.write.parquet(f"{path}/history")
        text = json.dumps(self.roles.__dict__)
        session = self.history.sparkSession
        session.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/roles")

    @staticmethod
    def load(spark: SparkSession, path: str, prune_history: bool = False) -> FeatureBuilderModel:
        roles = Roles(**json.loads(spark.read.text(f"{path}/roles").first()["value"]))
        return FeatureBuilderModel(spark.read.parquet(f"{path}/history"), roles, prune_history)


def feature_parity(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(feature, rows, mismatches) of the same rows through two paths.

    Both sides are grouped by row key instead of joined, so repeated keys combine on the map
    side. A key that is missing on a side, or repeated differently, mismatches.
    """

    def side(df: DataFrame, number: int) -> DataFrame:
        return df.select(key, F.lit(number).alias("_side"), *columns)

    both = side(a, 0).unionByName(side(b, 1))

    def on(number: int, column: Column) -> Column:
        return F.when(F.col("_side") == number, column)

    ends = []
    for i, c in enumerate(columns):
        # Wrapped, so that NULL values take part in the comparison.
        cell = F.struct(F.col(c).alias("v"))
        ends += [
            f(on(n, cell)).alias(f"{name}{n}_{i}")
            for n in (0, 1)
            for name, f in (("low", F.min), ("high", F.max))
        ]
    counts = [F.count(on(n, F.lit(1))).alias(f"n{n}") for n in (0, 1)]
    grouped = both.groupBy(key).agg(*counts, *ends)

    def differs(i: int) -> Column:
        same = F.col("n0") == F.col("n1")
        for left, right in (("low0", "high0"), ("low0", "low1"), ("low1", "high1")):
            same = same & F.col(f"{left}_{i}").eqNullSafe(F.col(f"{right}_{i}"))
        return ~same

    row = grouped.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(differs(i)).alias(c) for i, c in enumerate(columns)],
    )
    return row.unpivot("rows", columns, "feature", "mismatches").select(
        "feature", "rows", "mismatches"
    )
