"""What the plans must and must not contain at scale."""

import re

import pytest

import __spark_entry__ as entry
from riskspark.plans.adapter import appointments, table
from riskspark.operators.clean import split_part
from riskspark.plans.adapter import SPLIT
from riskspark.session import shared_dir
from tests.conftest import SF

CORE = [
    "asof_history", "pr_curve", "psi_numeric", "failing_cells", "metrics_by_split", "latency_quantiles",
    "feature_parity", "entities_in_two_splits", "alerts_per_sliding_hour", "feedback_rows",
]


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", CORE)
def test_no_python_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for word in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_history_shuffles_days_not_rows(spark):
    """Only (entity, day) aggregates reach the per-entity window."""
    text = plan(entry.queries()["asof_history"](spark, SF))
    window = text[: text.index("(1) Scan")]
    below = window[window.index("Window"):]
    assert "HashAggregate" in below and re.search(r"Window.*?Sort.*?Exchange.*?Union.*?HashAggregate", below, re.S)


def test_scan_reads_only_needed_columns(spark):
    text = plan(split_part(appointments(spark, SF, place=False), "train", SPLIT).select("appointment_id"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"o_orderkey", "o_orderdate"}


def test_time_filter_reaches_the_scan_of_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "rows")
    appointments(spark, SF, place=False).write.parquet(path)
    text = plan(split_part(spark.read.parquet(path), "val", SPLIT).select("patient_id"))
    assert "GreaterThan(appointment_day" in text and "LessThanOrEqual(appointment_day" in text


def test_entry_and_registry(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 90
    found = entry.entry(spark)
    assert found.columns == ["appointment_id", "split", "previous_appointments", "previous_miss_rate"]
    assert found.count() > 1000


def test_shared_dir_prefers_the_cluster_setting(spark):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        def __init__(self, value):
            self.conf, self.sparkContext = {"spark.checkpoint.dir": value}, Context()

    assert shared_dir(Session("hdfs://x/work/"), "a").startswith("hdfs://x/work/a-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(None), "a")
    assert shared_dir(spark, "a") != shared_dir(spark, "a")
    assert table(spark, SF, "nation").count() == 25
