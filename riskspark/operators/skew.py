"""Row-level joins that stay balanced when one key holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot from 1/HOT_SHARE of all rows on, so there can be at most HOT_SHARE hot keys:
# the broadcast list below never grows with the data.
HOT_SHARE = 2000
# Copies of lookup rows added over all hot keys together.
FAN_OUT = 4096


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    weight: str,
    how: str = "left",
) -> DataFrame:
    """Join rows to a lookup that has one row per key.

    ``weight`` is the lookup column that counts the rows of each key (0 or NULL where the rows
    have none); it is dropped. Hot keys are spread over several reducers in proportion to
    their share and their lookup row is repeated as often. Rows with a NULL key match nothing
    and are spread too.
    """
    keys = list(keys)
    total = lookup.agg(F.sum(weight).alias("t")).scalar()
    hot = (
        lookup.select(*keys, F.col(weight).alias("_w"))
        .withColumn("_t", total)
        .where((F.col("_w") > 0) & (F.col("_w") * HOT_SHARE >= F.col("_t")))
        .select(*keys, F.ceil(F.col("_w") * FAN_OUT / F.col("_t")).cast("int").alias("_salts"))
    )
    hashed = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *hashed), F.lit(FAN_OUT))
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    # The reducer choice follows the map task and the whole row: rows of one task spread, identical
    # rows of several tasks too, and a task that runs again makes the same choice.
    left = (
        rows.withColumn("_spread", spread)
        .join(F.broadcast(hot), keys, "left")
        .withColumn(
            "_salt",
            F.when(no_key, F.col("_spread")).otherwise(
                F.pmod(F.col("_spread"), F.coalesce(F.col("_salts"), F.lit(1)))
            ),
        )
        .drop("_spread", "_salts")
    )
    right = (
        lookup.drop(weight)
        .join(F.broadcast(hot), keys, "left")
        .withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
        )
        .drop("_salts")
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
