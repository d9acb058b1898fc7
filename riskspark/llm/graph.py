"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (a, b) with the smallest node it can reach.

    Two steps take turns until nothing changes: each node hands its smallest neighbour to its
    larger neighbours, then to its smaller ones. Both keep the components, and both shrink
    paths, so the number of rounds grows with the logarithm of the longest path. Edges with a
    null end or equal ends are dropped. All tables stay distributed; one count per round
    reaches the driver.
    """
    high, low = F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    now = edges.where(F.col("a") != F.col("b")).select(high, low).distinct()
    now, before = written(now, "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low") % 1_000_003)).first()
        if mark == before:
            return now.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
                now.select("low", "low").distinct()
            )
        before = mark
        both = now.union(now.select("low", "high")).toDF("u", "v")
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = both.where(F.col("v") > F.col("u")).join(smallest, "u")
        step = larger.select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        step = written(step, "edges")
        parent = step.groupBy("high").agg(F.min("low").alias("m"))
        turned = step.join(parent, "high").where(F.col("low") != F.col("m"))
        now = (
            turned.select(F.col("low").alias("high"), F.col("m").alias("low"))
            .union(parent.select("high", "m"))
            .where(F.col("high") != F.col("low"))
            .distinct()
        )
        now = written(now, "edges")
