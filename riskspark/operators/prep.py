"""Model preparation fitted on the training rows: fill values, scaling, one-hot, weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.features import CATEGORICAL, NUMERIC
from riskspark.operators.ordered import quantiles_of_counts


def _cells(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(feature, value, n) over non-NULL cells."""
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(kind).alias("value"))
        for c in columns
    ]
    long = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    if kind == "double":
        long = long.where(~F.isnan("value"))
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, fill): most frequent value, the smallest of equals."""
    counts = _cells(df, columns, "string")
    return counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("fill"))


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, fill): exact median."""
    return quantiles_of_counts(_cells(df, columns, "double"), "value", {"fill": 0.5}, ["feature"])


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, deviation), population deviation."""
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.avg(c).alias("mean"),
                    F.stddev_pop(c).alias("deviation"),
                )
                for c in columns
            ]
        ).alias("m")
    )
    return row.select(F.inline("m"))


def _as_dict(rows: DataFrame, value: str) -> dict:
    """One entry per column of the table."""
    return {r["feature"]: r[value] for r in rows.collect()}


def impute_mode(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    fills = _as_dict(modes(train, columns), "fill")
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def impute_median(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    fills = _as_dict(medians(train, columns), "fill")
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in fills.items()}
    )


def standardize(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    found = {r["feature"]: r for r in moments(train, columns).collect()}
    scaled = {}
    for c in columns:
        mean, deviation = found[c]["mean"], found[c]["deviation"]
        scaled[c] = (F.col(c).cast("double") - F.lit(mean)) / F.lit(deviation or 1.0)
    return df.withColumns(scaled)


def one_hot(columns: Sequence[str], suffix: str = "_hot") -> Pipeline:
    """Sorted training categories to indicator vectors; an unseen category is all zeros.

    The indexer puts unseen values in an extra last slot, which the encoder then drops.
    """
    index = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    encode = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}{suffix}" for c in columns],
        dropLast=True,
    )
    return Pipeline(stages=[index, encode])


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fill_and_scale(
    train: DataFrame, categorical: Sequence[str], numeric: Sequence[str]
) -> SQLTransformer:
    """One persistable stage: ``<c>_filled`` for text, ``<c>_scaled`` for numbers."""
    words = _as_dict(modes(train, categorical), "fill")
    middles = _as_dict(medians(train, numeric), "fill")
    filled = train.select(
        [F.coalesce(F.col(c).cast("double"), F.lit(middles.get(c, 0.0))).alias(c) for c in numeric]
    )
    found = {r["feature"]: r for r in moments(filled, numeric).collect()}
    columns = [f"coalesce(`{c}`, {_quoted(words.get(c, ''))}) AS `{c}_filled`" for c in categorical]
    for c in numeric:
        mean, deviation = found[c]["mean"], found[c]["deviation"] or 1.0
        value = f"coalesce(CAST(`{c}` AS DOUBLE), {middles.get(c, 0.0)!r}D)"
        columns.append(f"({value} - ({mean!r}D)) / {deviation!r}D AS `{c}_scaled`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def assemble(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    """Column groups to one vector; names stay in the column's metadata."""
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def fit_preprocessor(
    train: DataFrame,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
) -> PipelineModel:
    """Fill, scale, encode and assemble, fitted on ``train`` only."""
    filled = [f"{c}_filled" for c in categorical]
    hot = one_hot(filled, suffix="_hot").getStages()
    parts = [f"{c}_hot" for c in filled] + [f"{c}_scaled" for c in numeric]
    stages = [fill_and_scale(train, categorical, numeric), *hot, assemble(parts)]
    return Pipeline(stages=stages).fit(train)


def feature_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Slot names from the vector column's metadata."""
    groups = df.schema[vector].metadata["ml_attr"]["attrs"]
    slots = [slot for group in groups.values() for slot in group]
    return [slot["name"] for slot in sorted(slots, key=lambda slot: slot["idx"])]


def balanced_weight(df: DataFrame, label: str = "target", name: str = "weight") -> DataFrame:
    """Add n / (2 * rows of the class) to every row; the class counts are one scalar row."""
    yes, no = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    counts = df.agg(F.struct(yes.alias("yes"), no.alias("no")).alias("c")).scalar()
    rows = F.col("_c.yes") + F.col("_c.no")
    weight = F.when(F.col(label) == 1, F.try_divide(rows, 2.0 * F.col("_c.yes"))).when(
        F.col(label) == 0, F.try_divide(rows, 2.0 * F.col("_c.no"))
    )
    return df.withColumn("_c", counts).withColumn(name, weight).drop("_c")
