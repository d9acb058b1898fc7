"""A stored profile of the reference data, against which new data are judged without it.

A profile is a small table: per monitored column its bin edges and how many reference rows each bin or
category held. Profiles of parts add up, as long as they share their edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import MISSING
from riskspark.operators.drift import feature_counts, psi_of_bins, reference_edges

SCHEMA = "version string, feature string, numeric boolean, edges array<double>, bin string, n long"


def _bin(edges: Column, value: Column) -> Column:
    return F.size(F.filter(edges, lambda e: e <= value)).cast("string")


def fit_profile(
    ref: DataFrame, numeric: Sequence[str] = (), text: Sequence[str] = (), version: str = "1", bins: int = 10
) -> DataFrame:
    """Profile rows: the reference's quantile bins of numeric columns, and categories of text columns.

    NULL and NaN are no numeric values; NULL is a category of its own. A column without any value has
    no row, and new data cannot drift from it.
    """
    counts = feature_counts(ref, ref.where(F.lit(False)), numeric, text)
    edges = F.broadcast(reference_edges(counts, bins))  # one row per numeric column
    numeric_row = F.col("category").isNull()
    return (
        counts.join(edges, "feature", "left")
        .groupBy(
            "feature",
            numeric_row.alias("numeric"),
            F.when(numeric_row, F.coalesce("inner", F.array().cast("array<double>"))).alias("edges"),
            F.coalesce("category", _bin(F.col("inner"), F.col("value"))).alias("bin"),
        )
        .agg(F.sum("ref").alias("n"))
        .select(F.lit(version).alias("version"), "feature", "numeric", "edges", "bin", "n")
    )


def write_profile(profile: DataFrame, path: str) -> None:
    profile.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_profile(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).where(F.col("version") == version)


def refit_counts(profile: DataFrame, more: DataFrame) -> DataFrame:
    """The profile with the rows of ``more`` counted in, at the same edges."""
    added = binned_counts(profile, more).join(F.broadcast(_columns(profile)), "feature")
    version = profile.select("version").limit(1)
    both = profile.drop("version").unionByName(added.select("feature", "numeric", "edges", "bin", F.col("cur").alias("n")))
    summed = both.groupBy("feature", "numeric", "edges", "bin").agg(F.sum("n").alias("n"))
    return summed.withColumn("version", version.scalar()).select(*profile.columns)


def merge_profiles(a: DataFrame, b: DataFrame) -> DataFrame:
    """The profile of both parts, under the first one's version. Their edges must be the same."""
    left, right = _columns(a), _columns(b)
    differ = left.join(right.select("feature", F.col("edges").alias("others")), "feature").where("NOT edges <=> others")
    if not differ.isEmpty():
        raise ValueError("profiles with different edges cannot be merged")
    both = a.drop("version").unionByName(b.drop("version"))
    summed = both.groupBy("feature", "numeric", "edges", "bin").agg(F.sum("n").alias("n"))
    return summed.withColumn("version", a.select("version").limit(1).scalar()).select(*a.columns)


def _columns(profile: DataFrame) -> DataFrame:
    """One row per monitored column."""
    return profile.select("feature", "numeric", "edges").distinct()


def binned_counts(profile: DataFrame, cur: DataFrame, by: Sequence[Column] = ()) -> DataFrame:
    """(by..., feature, bin, cur): rows of new data, batch or stream, in the profile's bins.

    Columns that the profile does not know are left out. What the plan reads of the reference is the
    profile's one row per column.
    """
    cells = []
    for f in cur.schema.fields:
        column = F.col(f"`{f.name}`")
        is_text = isinstance(f.dataType, (T.StringType, T.BooleanType))
        cells.append(
            F.struct(
                F.lit(f.name).alias("feature"),
                (F.lit(None) if is_text else column.try_cast("double")).cast("double").alias("value"),
                F.coalesce(column.cast("string"), F.lit(MISSING)).alias("category"),
            )
        )
    long = cur.select(*by, F.inline(F.array(*cells)))
    names = [c for c in long.columns if c not in ("feature", "value", "category")]
    placed = long.join(F.broadcast(_columns(profile)), "feature")
    known = ~F.col("numeric") | (F.col("value").isNotNull() & ~F.isnan("value"))
    bin_of = F.when(F.col("numeric"), _bin(F.col("edges"), F.col("value"))).otherwise(F.col("category"))
    counts = placed.where(known).groupBy(*names, "feature", bin_of.alias("bin"))
    return counts.agg(F.count(F.lit(1)).alias("cur"))


def psi_of_profile(profile: DataFrame, counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, psi) of binned counts of new data, for every column of the profile.

    Groups are those that occur in the counts.
    """
    groups = counts.select(*by).distinct() if by else None
    expected = profile.select("feature", "numeric", "bin", F.col("n").alias("ref"))
    if groups is not None:
        # One copy of the small profile for each group.
        expected = groups.withColumn("_one", F.lit(1)).join(expected.withColumn("_one", F.lit(1)), "_one").drop("_one")
    keys = [*by, "feature", "bin"]
    found = counts.join(F.broadcast(profile.select("feature", "numeric").distinct()), "feature")
    both = expected.withColumn("cur", F.lit(0).cast("long")).unionByName(
        found.select(*by, "feature", "numeric", "bin", F.lit(0).cast("long").alias("ref"), "cur")
    )
    binned = both.groupBy(*keys, "numeric").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    # Every column of the profile has rows in every group.
    shown = binned.select(*by, "feature").distinct()
    return shown.join(psi_of_bins(binned, by), [*by, "feature"], "left").select(
        *by, "feature", F.coalesce("psi", F.lit(0.0)).alias("psi")
    )


def psi_from_profile(profile: DataFrame, cur: DataFrame) -> DataFrame:
    """(feature, psi) of new data against a stored profile."""
    return psi_of_profile(profile, binned_counts(profile, cur))
