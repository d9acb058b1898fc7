"""Generated appointments whose outcome depends on the lead time, so that models can learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Place names of generated rows.
PLACES = ["NORDHAFEN", "OBERFELD", "SUEDTOR", "WESTEND"]


def uniform(key: Column, seed: int, stream: str) -> Column:
    """A number in [0, 1) from the row key alone: the same under any partitioning."""
    bits = F.pmod(F.xxhash64(key, F.lit(seed), F.lit(stream)), F.lit(1 << 52))
    return bits / F.lit(float(1 << 52))


def synthetic_appointments(
    keys: DataFrame,
    key: str,
    seed: int = 42,
    entities: int = 119,
    start: str = "2016-01-01",
    days: int = 150,
) -> DataFrame:
    """One appointment per key row; P(missed) = 0.1 + lead / 40 with a lead of 0 to 29 days."""

    def draw(stream: str, n: int) -> Column:
        return F.floor(uniform(F.col(key), seed, stream) * n).cast("int")

    def flag(stream: str, share: float) -> Column:
        return (uniform(F.col(key), seed, stream) < share).cast("int")

    lead = draw("lead", 30)
    booked = F.date_add(F.lit(start).cast("date"), draw("day", days))
    missed = uniform(F.col(key), seed, "outcome") < 0.1 + lead / 40
    return keys.select(
        (draw("entity", entities) + 1).cast("double").alias("patient_id"),
        F.col(key).cast("long").alias("appointment_id"),
        F.when(uniform(F.col(key), seed, "gender") < 0.5, "F").otherwise("M").alias("gender"),
        booked.cast("timestamp").alias("scheduled_day"),
        F.date_add(booked, lead).cast("timestamp").alias("appointment_day"),
        draw("age", 96).alias("age"),
        F.get(F.array(*[F.lit(p) for p in PLACES]), draw("place", len(PLACES))).alias(
            "neighbourhood"
        ),
        flag("scholarship", 0.1).alias("scholarship"),
        flag("hipertension", 0.2).alias("hipertension"),
        flag("diabetes", 0.07).alias("diabetes"),
        flag("alcoholism", 0.03).alias("alcoholism"),
        flag("handcap", 0.02).alias("handcap"),
        flag("sms", 0.32).alias("sms_received"),
        F.when(missed, "Yes").otherwise("No").alias("no_show"),
    )
