"""Column expressions shared by batch jobs, model pipelines and streams. All JVM-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label words and their meaning.
POSITIVE_WORDS = ["yes", "y", "true", "1"]
NEGATIVE_WORDS = ["no", "n", "false", "0"]

# Upper (inclusive) age bounds and group names; the last group is open.
AGE_BOUNDS = [12, 18, 35, 55, 75]
AGE_GROUPS = ["child", "teen", "young_adult", "adult", "senior", "elderly"]

MISSING = "<missing>"

_DATED = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def parse_time(text: Column) -> Column:
    """ISO text to a UTC timestamp, NULL when it does not parse.

    The pattern guard keeps out time-only text, which a cast would place on today's date.
    """
    return F.when(text.rlike(_DATED), text.try_cast("timestamp"))


def day(time: Column) -> Column:
    return F.to_date(time)


def clip_upper(value: Column, top: float) -> Column:
    """Values above ``top`` become ``top``; NULL stays NULL (``least`` would drop it)."""
    return F.when(value > top, F.lit(top)).otherwise(value)


def clip_lower(value: Column, bottom: float) -> Column:
    return F.when(value < bottom, F.lit(bottom)).otherwise(value)


def encode_target(label: Column, positive: str = "Yes") -> Column:
    """1 for the positive label, 0 for any other value including NULL."""
    return F.when(label == positive, 1).otherwise(0)


def yes_no(label: Column) -> Column:
    """Yes/No to 1/0, anything else NULL."""
    return F.when(label == "Yes", 1).when(label == "No", 0)


def normalize_label(label: Column, numeric: bool = False) -> Column:
    """Free-form label to 1/0/NULL. Numeric labels pass only when exactly 0 or 1."""
    if numeric:
        return F.when(label.isin(0, 1), label.cast("int"))
    word = F.lower(F.trim(label.cast("string")))
    return F.when(word.isin(POSITIVE_WORDS), 1).when(word.isin(NEGATIVE_WORDS), 0)


def lead_time_days(known_at: Column, outcome_at: Column) -> Column:
    """Whole days between calendar days, never below 0, NULL kept."""
    return clip_lower(F.datediff(day(outcome_at), day(known_at)), 0)


def lead_time_fraction(known_at: Column, outcome_at: Column) -> Column:
    """Exact difference in days, fractional and possibly negative."""
    micros = F.unix_micros(outcome_at) - F.unix_micros(known_at)
    return micros / F.lit(86_400_000_000.0)


def weekday_name(time: Column) -> Column:
    return F.date_format(time, "EEEE")


def weekday_number(time: Column) -> Column:
    """Monday is 0."""
    return F.weekday(time)


def age_group(age: Column) -> Column:
    """Right-closed age groups."""
    chain = F.when(age <= AGE_BOUNDS[0], AGE_GROUPS[0])
    for bound, name in zip(AGE_BOUNDS[1:], AGE_GROUPS[1:-1]):
        chain = chain.when(age <= bound, name)
    return chain.when(age > AGE_BOUNDS[-1], AGE_GROUPS[-1])


def normalize_place(name: Column) -> Column:
    return F.upper(F.trim(name))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as a double, 0 when the bottom is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def count_rows() -> Column:
    return F.count(F.lit(1))


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first spelling that the table has."""
    return next((name for name in candidates if name in df.columns), None)
