"""A verdict per raw file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.validate import check_columns, file_verdicts
from riskspark.schema import RAW_FIELDS, Field
from riskspark.sources.readers import read_raw


def validate_files(
    spark: SparkSession,
    paths: Sequence[str],
    fields: Sequence[Field] = RAW_FIELDS,
    expect_fail: bool = False,
) -> DataFrame:
    """(file, problems, status, expected) for raw CSV files or folders of them.

    A file whose columns differ is judged by its header alone; all others are read in one job.
    """
    judged, rows = [], []
    for path in paths:
        raw = read_raw(spark, path)
        judged.append((path, len(check_columns(raw, fields))))
        if judged[-1][1] == 0:
            rows.append(raw.withColumn("file", F.lit(path)))
    headers = spark.createDataFrame(judged, "file string, wrong long")
    if not rows:
        found = headers.withColumn("problems", F.col("wrong"))
    else:
        union = rows[0]
        for part in rows[1:]:
            union = union.unionByName(part)
        readable = headers.where("wrong = 0")
        by_rows = file_verdicts(union, fields, readable).select("file", "problems")
        found = headers.join(by_rows, "file", "left").withColumn(
            "problems", F.coalesce("problems", "wrong")
        )
    wanted = "INVALID" if expect_fail else "VALID"
    status = F.when(F.col("problems") > 0, "INVALID").otherwise("VALID")
    return found.select("file", "problems", status.alias("status")).withColumn(
        "expected", F.col("status") == wanted
    )
