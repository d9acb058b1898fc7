import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import metrics as M
from riskspark.operators.ordered import exact_quantiles, running_totals
from riskspark.operators.skew import lookup_join


@pytest.fixture(scope="module")
def scored(spark):
    """Three groups, one with most rows and one score shared by a third of them."""
    rng = np.random.default_rng(3)
    rows = []
    for group, n in (("a", 4000), ("b", 60), (None, 200)):
        score = np.round(rng.random(n), 3)
        score[rng.random(n) < 0.33] = 0.5
        label = (rng.random(n) < 0.2 + 0.4 * score).astype(int)
        rows += [(group, float(s), int(y), i) for i, (s, y) in enumerate(zip(score, label))]
    df = spark.createDataFrame(rows, "g string, score double, y int, id int").repartition(6).cache()
    return df, rows


@pytest.mark.parametrize("ranges", [2, 16, 1000, None])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_sorted_loop(scored, ranges, descending):
    df, rows = scored
    points = df.groupBy("g", "score").agg(F.count("*").alias("n"), F.sum("y").alias("k"))
    found = running_totals(points, "score", ["n", "k"], ["g"], descending, True, ranges).collect()
    by = {(r["g"], r["score"]): r for r in found}
    for group in ("a", "b", None):
        own = [(s, y) for g, s, y, _ in rows if g == group]
        run, seen = 0, sorted({s for s, _ in own}, reverse=descending)
        for i, s in enumerate(seen):
            run += sum(1 for x, _ in own if x == s)
            row = by[(group, s)]
            assert row["run_n"] == run and row["all_n"] == len(own)
            assert row["next_score"] == (seen[i + 1] if i + 1 < len(seen) else None)
        assert row["run_k"] == sum(y for _, y in own) == row["all_k"]
    assert len(by) == len(found)


def test_quantiles_equal_numpy(scored):
    df, rows = scored
    probs = {f"q{i}": i * 0.1 for i in range(11)}
    for group in ("a", "b"):
        own = np.array([s for g, s, _, _ in rows if g == group])
        row = exact_quantiles(df.where(F.col("g") == group), "score", probs).first()
        assert [row[k] for k in probs] == pytest.approx(list(np.quantile(own, list(probs.values()))))
    nearest = exact_quantiles(df, "score", {"p": 0.95}, ["g"], method="nearest").where("g = 'a'").first()
    own = sorted(s for g, s, _, _ in rows if g == "a")
    assert nearest["p"] == own[int(round(0.95 * (len(own) - 1)))]


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert exact_quantiles(empty, "v", {"p": 0.5}).first()["p"] is None


def brute(y, s):
    y, s = np.array(y), np.array(s)
    order = sorted(set(s.tolist()), reverse=True)
    ap, last = 0.0, 0.0
    for t in order:
        hit = y[s >= t]
        recall = hit.sum() / y.sum()
        ap += (recall - last) * hit.mean()
        last = recall
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])
    return ap, auc


def brute_threshold(y, s, min_recall):
    y, s = np.array(y), np.array(s)
    best = (0.0, 0.5)
    feasible = []
    for t in sorted({0.0, 1.0, *s.tolist()}):
        hit = y[s >= t]
        recall = hit.sum() / y.sum() if y.sum() else 0.0
        if recall >= min_recall:
            feasible.append((hit.mean() if len(hit) else 0.0, t))
    return max(feasible, default=best)[1]


def test_metrics_equal_brute_force(scored):
    df, rows = scored
    ap = {r["g"]: r["pr_auc"] for r in M.average_precision(df, "y", "score", ["g"]).collect()}
    auc = {r["g"]: r["roc_auc"] for r in M.roc_auc(df, "y", "score", ["g"]).collect()}
    for group in ("a", "b", None):
        y, s = zip(*[(y, s) for g, s, y, _ in rows if g == group])
        assert (ap[group], auc[group]) == pytest.approx(brute(y, s))
        for recall in (0.0, 0.6, 1.0):
            found = M.choose_threshold(df, "y", "score", recall, ["g"]).collect()
            assert {r["g"]: r["threshold"] for r in found}[group] == brute_threshold(y, s, recall)


def four(spark, rows=((1, 0.9), (1, 0.6), (0, 0.7), (0, 0.1))):
    return spark.createDataFrame(list(rows), "y int, score double")


def test_four_rows(spark):
    df = four(spark)
    assert M.choose_threshold(df, "y", "score", 1.0).first()["threshold"] == 0.6
    assert M.average_precision(df, "y", "score").first()[0] == pytest.approx(0.8333, abs=1e-4)
    assert M.roc_auc(df, "y", "score").first()[0] == 0.75
    row = M.with_rates(M.confusion(df, "y", "score", 0.6)).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (2, 1, 0, 1)
    assert (row["precision"], row["recall"], row["accuracy"]) == pytest.approx((2 / 3, 1.0, 0.75))


def test_degenerate_inputs(spark):
    negatives = four(spark, [(0, 0.2), (0, 0.8), (None, 0.9), (1, None)])
    assert M.roc_auc(negatives, "y", "score").first()[0] is None
    assert M.choose_threshold(negatives, "y", "score", 0.6).first()["threshold"] == 0.5
    assert M.average_precision(negatives, "y", "score").first()[0] == 0.0
    row = M.classification_metrics(negatives, "y", "score", 0.9).first()
    assert (row["recall"], row["precision"]) == (0.0, 0.0)
    assert M.positive_rate(four(spark, [(1, None)]), "score", 0.5).first()[0] is None


def test_budget_breaks_ties_by_id(scored):
    df, rows = scored
    known = df.where("g IS NOT NULL")
    for budget in (10, 40, 700, 2000):
        found = {r["g"]: r for r in M.compare_at_budget(known, "y", "score", "id", budget, "g").collect()}
        for group in ("a", "b"):
            own = sorted(((-s, i, y) for g, s, y, i in rows if g == group))[:budget]
            assert found[group]["alerts"] == len(own)
            assert found[group]["hits"] == sum(y for _, _, y in own)


def test_lookup_join_equals_plain_join(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 10 == 1, None)
        .otherwise(F.col("id") % 500)
        .alias("k"),
        "id",
    ).repartition(8)
    counts = rows.groupBy("k").agg(F.count("*").alias("w")).where("k IS NOT NULL AND k % 2 = 1")
    lookup = counts.withColumn("v", F.col("k") * 10)
    for how in ("left", "inner", "left_semi"):
        found = lookup_join(rows, lookup, ["k"], "w", how)
        plain = rows.join(lookup.drop("w"), "k", how).select(found.columns)
        assert found.count() == plain.count()
        assert found.exceptAll(plain).count() == 0
    salted = lookup_join(rows.select("k", "id"), lookup, ["k"], "w", "inner")
    assert salted.where("k = 7").count() == rows.where("k = 7").count()


def test_hot_key_of_a_single_map_task_is_spread(spark):
    rows = spark.range(0, 20_000, 1, 1).withColumn("k", F.lit(1))
    lookup = spark.createDataFrame([(1, "x", 20_000)], "k int, v string, w long")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup_join(rows, lookup, ["k"], "w")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) <= 2 * 20_000 / 8
