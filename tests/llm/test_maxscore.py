import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm.maxscore import Best, top_k

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, is_query, k):
    usable = [
        (i, [math.floor(256 * x) for x in np.array(v, np.float32).astype(float).tolist()])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, asked = [], {}
    for i, v in usable:
        if is_query(i):
            asked.setdefault(i, v)
    for q, qv in asked.items():
        scored = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed, dims", [(1, 3), (2, 16), (3, 1)])
def test_against_brute_force(spark, seed, dims):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(dims)], "x") for i in range(300)]
    rows += [(1000 + i, rows[0][1], "x") for i in range(150)]  # a third is one vector, all tied
    rows += [
        (None, [0.0] * dims, "x"),
        (400, None, "x"),
        (410, [None] * dims, "x"),
        (420, [float("nan")] * dims, "x"),
        (430, [float("inf")] * dims, "x"),
        (440, [], "x"),
        (441, [0.5], "x"),
        rows[7],
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = top_k(df, F.col("vec_id") % 10 == 0, k=5, block=16)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0, 5)


def test_pruned_search_equals_full_products():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-300, 300, (5000, 24)) * (rng.random((5000, 24)) < 0.3)
    queries, ids = vectors[:40], np.arange(5000)
    best = Best(ids[:40], queries, 5)
    for at in range(0, 5000, 900):
        best.search(ids[at : at + 900], vectors[at : at + 900])
    full = queries @ vectors.T
    for q in range(40):
        order = [i for i in np.lexsort((ids, -full[q])) if i != q][:5]
        assert best.found[q][1].tolist() == order


def test_few_and_no_rows(spark):
    assert top_k(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    two = spark.createDataFrame([(0, [1.0], ""), (1, [-1.0], "")], SCHEMA)
    got = top_k(two, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, -65536)]


@pytest.mark.parametrize("seed", [1, 2])
def test_large_components_count_exactly(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([0.25, -3.5, 600_000.0, -7e5, 1e6]) for _ in range(3)], "x") for i in range(300)]
    rows += [(500, [3e7, 2.0, 0.0], "x"), (501, [-1e3, 1e7, 1.0], "x"), (505, [600_000.0, 1.0], "x")]
    got = top_k(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 5 == 0, k=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 5 == 0, 5)


def test_integers_of_any_size():
    rng = random.Random(4)
    exact = lambda: [rng.choice([0, 3, -5, 2**40 + 1, -(2**70), 2**65 + 7]) for _ in range(6)]
    vectors = np.array([exact() for _ in range(400)], object)
    best = Best(np.arange(20), vectors[:20], 5)
    for at in range(0, 400, 150):
        best.search(np.arange(at, min(at + 150, 400)), vectors[at : at + 150])
    for q in range(20):
        full = [(-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in enumerate(vectors) if i != q]
        assert best.found[q][1].tolist() == [i for _, i in sorted(full)[:5]]
    with pytest.raises(OverflowError):
        list(best.rows())


def test_scores_beyond_64_bits_are_an_error(spark):
    wide = spark.createDataFrame([(0, [500_000.0] * 1024), (1, [500_000.0] * 1024)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="64 bits"):
        top_k(wide, F.col("vec_id") == 0).collect()
    huge = spark.createDataFrame([(0, [1e300, 1.0]), (1, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_k(huge, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2 * 65536)]
