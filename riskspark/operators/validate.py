"""Validation that reports every failing cell instead of stopping at the first one.

All row rules of a table compile into one projection, so a whole contract costs one scan.
Only key uniqueness needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import parse_time
from riskspark.operators.skew import lookup_join
from riskspark.schema import Field

FAILURE = "struct<column:string,check:string,value:string>"


def _text(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def _failure(bad: Column, column: str, check: str, value: Column) -> Column:
    found = F.struct(F.lit(column).alias("column"), F.lit(check).alias("check"), value.alias("value"))
    return F.when(bad, found)


def cell_failures(field: Field) -> list[Column]:
    """Failure structs of one column; each is NULL when its check passes."""
    raw = F.col(f"`{field.name}`")
    value = _text(field.name)
    out = [_failure(raw.isNull(), field.name, "not_null", value)]
    typed = field.typed()
    if field.type != "string":
        bad_type = raw.isNotNull() & typed.isNull()
        out.append(_failure(bad_type, field.name, f"dtype({field.type})", value))
    for check, holds in field.domain():
        out.append(_failure(typed.isNotNull() & ~holds, field.name, check, value))
    if field.time:
        bad_time = raw.isNotNull() & parse_time(value).isNull()
        out.append(_failure(bad_time, field.name, "parses_as_time", value))
    return out


def row_failures(fields: Sequence[Field], extra: Sequence[Column] = ()) -> Column:
    """Array of all failures of a row."""
    found = [failure for field in fields for failure in cell_failures(field)]
    return F.filter(F.array(*found, *extra), lambda f: f.isNotNull())


def check_columns(df: DataFrame, fields: Sequence[Field]) -> list[tuple[str, str]]:
    """(column, check) for missing and extra columns; reads metadata only."""
    wanted = [f.name for f in fields]
    missing = [(name, "column_in_dataframe") for name in wanted if name not in df.columns]
    extra = [(name, "column_in_schema") for name in df.columns if name not in wanted]
    return missing + extra


def coerce_types(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Cast to the declared types; cells that do not fit become NULL.

    Whole-number targets should come from text: '3.5' fails there, while a DOUBLE 3.5 would
    be cut to 3.
    """
    return df.select([f.typed().alias(f.name) for f in fields if f.name in df.columns])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n) for keys that occur more than once."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1")


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Every row whose key occurs more than once."""
    return lookup_join(df, duplicate_keys(df, key), [key], "n", how="left_semi").select(df.columns)


def failure_report(
    df: DataFrame,
    fields: Sequence[Field],
    key: Sequence[str],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """(key..., column, check, value) for every failing cell, duplicates of unique keys included."""
    present = [f for f in fields if f.name in df.columns]
    # Passing checks leave as NULL after the explode, which keeps the whole stage compiled.
    found = [failure for field in present for failure in cell_failures(field)]
    cells = (
        df.select(*key, F.explode(F.array(*found, *extra)).alias("f"))
        .where(F.col("f").isNotNull())
        .select(*key, "f.column", "f.check", "f.value")
    )
    for unique in [f for f in present if f.unique]:
        rows = df.select(*dict.fromkeys([*key, unique.name]))
        dupes = check_unique(rows, unique.name).select(
            *key,
            F.lit(unique.name).alias("column"),
            F.lit("unique").alias("check"),
            _text(unique.name).alias("value"),
        )
        cells = cells.unionByName(dupes)
    return cells


def failure_summary(report: DataFrame) -> DataFrame:
    return report.groupBy("column", "check").agg(F.count(F.lit(1)).alias("failures"))


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the table is empty")
    return df


def require_valid(df: DataFrame, fields: Sequence[Field], key: Sequence[str]) -> DataFrame:
    """Stop the job on an empty table, wrong columns or any failing cell."""
    wrong = check_columns(df, fields)
    if wrong:
        raise ValueError(f"wrong columns: {wrong}")
    require_rows(df)
    summary = failure_summary(failure_report(df, fields, key)).collect()
    if summary:
        found = sorted((r["column"], r["check"], r["failures"]) for r in summary)
        raise ValueError(f"invalid table: {found}")
    return df


def file_verdicts(
    df: DataFrame, fields: Sequence[Field], files: DataFrame, expect_fail: bool = False
) -> DataFrame:
    """(file, status, problems, expected) for every listed file.

    ``df`` holds the rows with a ``file`` column, ``files`` lists all files, so that a file
    without rows is found: an empty file is one problem. Key uniqueness counts per file.
    """
    present = [f for f in fields if f.name in df.columns]
    rows = df.select("file", F.size(row_failures(present)).cast("long").alias("bad"))
    parts = [rows.groupBy("file").agg(F.sum("bad").alias("problems"))]
    for unique in [f for f in present if f.unique]:
        counts = (
            df.where(F.col(f"`{unique.name}`").isNotNull())
            .groupBy("file", F.col(f"`{unique.name}`").alias("_key"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        parts.append(counts.where("n > 1").groupBy("file").agg(F.sum("n").alias("problems")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.groupBy("file").agg(F.sum("problems").alias("problems"))
    wrong_columns = len(check_columns(df.drop("file"), fields))
    problems = F.coalesce("problems", F.lit(1)) + wrong_columns
    wanted = "INVALID" if expect_fail else "VALID"
    return (
        files.select("file")
        .join(found, "file", "left")
        .select("file", problems.cast("long").alias("problems"))
        .withColumn("status", F.when(F.col("problems") > 0, "INVALID").otherwise("VALID"))
        .withColumn("expected", F.col("status") == wanted)
    )


def booked_after(known_at: str, outcome_at: str) -> Column:
    """Failure struct for a row known only after the day of its outcome."""
    known, outcome = _time(known_at), _time(outcome_at)
    late = F.to_date(known) > F.to_date(outcome)
    return _failure(late, known_at, "on_or_before_outcome_day", _text(known_at))


def _time(name: str) -> Column:
    return parse_time(_text(name))


def with_reasons(
    df: DataFrame,
    fields: Sequence[Field],
    known_at: str = "scheduled_day",
    outcome_at: str = "appointment_day",
    forbidden: Sequence[str] = (),
) -> DataFrame:
    """Add ``reasons``, the failures of a request row; works on batches and streams.

    A missing field fails as NULL. A forbidden field (the label, say) fails where it is sent.
    """
    absent = [f.name for f in fields if f.name not in df.columns]
    full = df.select("*", *[F.lit(None).cast("string").alias(name) for name in absent])
    extra = [booked_after(known_at, outcome_at)]
    extra += [
        _failure(F.col(f"`{n}`").isNotNull(), n, "extra_forbidden", _text(n))
        for n in forbidden
        if n in df.columns
    ]
    return full.withColumn("reasons", row_failures(fields, extra))


def split_requests(df: DataFrame, fields: Sequence[Field], **kwargs) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined with reasons)."""
    judged = with_reasons(df, fields, **kwargs)
    accepted = judged.where(F.size("reasons") == 0).drop("reasons")
    return accepted, judged.where(F.size("reasons") > 0)


def check_split(df: DataFrame, label: str, names: Sequence[str], split: str = "split") -> DataFrame:
    """(split, n, classes, ok): every part needs rows and both classes."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("c"))
    found = counts.groupBy(split).agg(
        F.sum("c").alias("n"), F.count_if(F.col(label).isNotNull()).alias("classes")
    )
    wanted = df.sparkSession.createDataFrame([(n,) for n in names], f"{split} string")
    return wanted.join(found, split, "left").select(
        split,
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("classes", F.lit(0)).alias("classes"),
        F.coalesce((F.col("n") > 0) & (F.col("classes") == 2), F.lit(False)).alias("ok"),
    )


def check_split_sizes(recorded: DataFrame, actual: DataFrame, split: str = "split") -> DataFrame:
    """(split, recorded_n, actual_n, same) from two (split, n) tables."""
    return (
        recorded.select(split, F.col("n").alias("recorded_n"))
        .join(actual.select(split, F.col("n").alias("actual_n")), split, "full")
        .withColumn("same", F.col("recorded_n").eqNullSafe(F.col("actual_n")))
    )
