"""Hilbert-curve sharding: metadata columns to a curve, the curve cut into runs of equal bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import written
from riskspark.operators.ordered import running_totals
from riskspark.operators.skew import lookup_join

BITS = 4


# Distinct values of a text dimension, up to which their levels are sent to every task.
FEW_VALUES = 10_000


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def text_levels(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """(name, n, level) of each value: the share of all rows that come before it, in 2**bits steps.

    Whole values count, in the order of their bytes. Exact running totals over the distinct values, so
    neither many values nor a frequent one gathers in a task.
    """
    counts = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    totals = running_totals(counts, name, ["n"])
    step = F.floor((F.col("run_n") - F.col("n")) * (1 << bits) / F.col("all_n")).cast("int")
    return totals.select(name, "n", step.alias("level"))


def with_text_level(rows: DataFrame, name: str, level: str, bits: int) -> DataFrame:
    """The rows with the level of their value in place of the value; null is level 0."""
    levels = written(text_levels(rows, name, bits), "shard-levels")
    if levels.limit(FEW_VALUES + 1).count() <= FEW_VALUES:
        joined = rows.join(F.broadcast(levels.drop("n")), name, "left")
    else:
        joined = lookup_join(rows, levels, [name], "n")
    return joined.withColumn(level, F.coalesce("level", F.lit(0))).drop(name, "level")


def hilbert_index(dims: Sequence[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of points with ``bits`` bits in each dimension.

    Undoes, from the highest bit down, the turns and mirrorings of the curve's quadrants, then
    reads the Gray code of the dimensions, bit by bit. Runs as one fold over (bit, dimension)
    steps, so the expression does not grow with bits.
    """
    if bits < 2:
        raise ValueError("a curve needs two bits or more in each dimension")
    n = len(dims)

    def turn(x: Column, step: Column) -> Column:
        q = F.call_function("shiftleft", F.lit(1), F.lit(bits - 1) - F.floor(step / n).cast("int"))
        i = F.pmod(step, F.lit(n))
        p = q - 1
        own, first = F.element_at(x, i + 1), F.element_at(x, 1)
        set_bit = own.bitwiseAND(q) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(p)
        new_first = F.when(set_bit, first.bitwiseXOR(p)).otherwise(first.bitwiseXOR(swap))
        new_own = F.when(set_bit, own).otherwise(own.bitwiseXOR(swap))
        return F.transform(
            x,
            lambda v, k: F.when(k == 0, new_first).when(k == i, new_own).otherwise(v),
        )

    def gray(x: Column, k: Column) -> Column:
        before = F.element_at(x, k)
        return F.transform(x, lambda v, j: F.when(j == k, v.bitwiseXOR(before)).otherwise(v))

    state = F.array(*[d.cast("int") for d in dims])
    # The highest bit and all below it, but for the lowest, turn the rest.
    state = F.aggregate(F.sequence(F.lit(0), F.lit((bits - 1) * n - 1)), state, turn)
    if n > 1:
        state = F.aggregate(F.sequence(F.lit(1), F.lit(n - 1)), state, gray)

    def fold(t: Column, b: Column) -> Column:
        q = F.call_function("shiftleft", F.lit(1), F.lit(bits - 1) - b)
        hit = F.element_at(state, n).bitwiseAND(q) != 0
        return F.when(hit, t.bitwiseXOR(q - 1)).otherwise(t)

    flip = F.aggregate(F.sequence(F.lit(0), F.lit(bits - 2)), F.lit(0).cast("int"), fold)
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(bits * n - 1)),
        F.struct(flip.alias("flip"), F.lit(0).cast("long").alias("h")),
        lambda s, k: F.struct(
            s["flip"].alias("flip"),
            (
                s["h"] * 2
                + F.call_function(
                    "shiftright",
                    F.element_at(state, F.pmod(k, F.lit(n)) + 1).bitwiseXOR(s["flip"]),
                    F.lit(bits - 1) - F.floor(k / n).cast("int"),
                )
                .bitwiseAND(F.lit(1))
                .cast("long")
            ).alias("h"),
        ),
        lambda s: s["h"],
    )


def hilbert_shards(
    docs: DataFrame,
    dims: Sequence[str] = ("lang", "source", "n_chars"),
    shards: int = 16,
    bits: int = BITS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, size, text_crc32, curve, shard, slot): runs along the curve with near equal bytes.

    Each dimension is cut into 2**bits levels, numbers at their quantiles and text by the rows with
    smaller values, whole values compared; a row's levels give its place on the Hilbert curve. Rows are put in the order (curve, hash of the text, key, size), so copies
    with the same metadata stand side by side, and the order is cut into ``shards`` runs: a row
    goes to the run in which the middle of its bytes lies. Size is the text's UTF-8 bytes plus
    1. Slots count from 0 in each run.

    Null texts have size 1 and the checksum of no bytes, 0. Null metadata and null keys sort first. Rows
    that repeat a key are placed one by one. An empty table gives an empty result; a single
    row or a text larger than a run leaves other runs empty. Other columns are ignored.

    Order, sizes and counts are range-partitioned on all of the order's columns, so neither a
    hot cell of the curve nor a group of copies gathers in one task; only one row per
    range partition meets in one task.
    """
    spark = docs.sparkSession
    body = F.col(f"`{text}`")
    numbers = {d for d in dims if _is_number(docs, d)}
    # One pass over the texts; after it only narrow rows move.
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(body, F.lit("")), "utf-8")).alias("crc"),
        F.xxhash64(body).alias("like"),
        *[
            (F.col(f"`{d}`").cast("double") if d in numbers else F.col(f"`{d}`").cast("string")).alias(f"d{i}")
            for i, d in enumerate(dims)
        ],
    )
    rows = written(rows, "shard-rows")
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    measured = [i for i, d in enumerate(dims) if d in numbers]
    if measured:
        edges = rows.agg(F.struct(*[F.percentile_approx(f"d{i}", cuts, 10_000).alias(f"e{i}") for i in measured]).alias("e"))
        rows = rows.withColumn("e", edges.scalar())
    for i in range(len(dims)):
        if i not in measured:
            rows = with_text_level(rows, f"d{i}", f"l{i}", bits)

    def level(i: int) -> Column:
        """How many of the dimension's cuts lie below the row."""
        if i not in measured:
            return F.col(f"l{i}")
        at, own = F.col("e")[f"e{i}"], F.col(f"d{i}")
        return F.coalesce(F.size(F.filter(at, lambda cut: cut < own)), F.lit(0)).alias(f"l{i}")

    order = ["curve", "like", "key", "size"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        rows.select("key", "size", "crc", "like", *[level(i) for i in range(len(dims))])
        .withColumn("curve", hilbert_index([F.col(f"l{i}") for i in range(len(dims))], bits))
        .repartitionByRange(partitions, *order)
        .withColumn("part", F.spark_partition_id())
    )
    # Written, so that a task that runs again cannot meet other range bounds.
    placed = written(placed, "shard-order")
    sums = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    run = (
        # One row per range partition: at most spark.sql.shuffle.partitions rows.
        placed.join(F.broadcast(offsets), "part")
        .withColumn("upto", F.col("bytes0") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside))
        .withColumn("shard", F.floor((2 * F.col("upto") - F.col("size")) * shards / (2 * F.col("total"))).cast("int"))
        .withColumn("shard", F.least(F.col("shard"), F.lit(shards - 1)))
    )
    run = written(run.select("key", "size", "crc", "curve", "part", "nth", "shard"), "shard-runs")
    # Rows of a shard in earlier partitions, and in its own partition before its first row.
    pieces = run.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        "shard", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    return run.join(F.broadcast(starts), ["shard", "part"]).select(
        F.col("key").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        "curve",
        "shard",
        (F.col("nth") + F.col("shift")).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the documents as one folder per shard, in slot order, for multidimensional pruning.

    Parquet keeps the smallest and largest value of each column per row group, and the curve
    keeps rows with like metadata together, so filters on any of its dimensions skip row groups.
    Expects unique keys.
    """
    where = placed.select(F.col(key).alias("_key"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    (
        docs.join(where, F.col(f"`{key}`").eqNullSafe(F.col("_key")))
        .repartitionByRange("_shard", "_slot")
        .sortWithinPartitions("_shard", "_slot")
        .drop("_key", "_slot")
        .write.partitionBy("_shard")
        .parquet(path)
    )
