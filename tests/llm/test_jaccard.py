import random
import re

import numpy as np
import pytest

from riskspark.llm.graph import components
from riskspark.llm.jaccard import class_counts, links_of_region, near_by_counts, near_duplicates

SCHEMA = "doc_id long, text string, n_shingles string, id string"


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    sets = [shingle_set(t, size) for _, t, *_ in rows]
    ids = [r[0] for r in rows]
    comp = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and ids[i] is not None and ids[j] is not None and 100 * len(a & b) >= percent * len(a | b):
                old, new = comp[i], comp[j]
                comp = [new if c == old else c for c in comp]
    smallest = {}
    for i, c in enumerate(comp):
        if ids[i] is not None:
            smallest[c] = min(smallest.get(c, ids[i]), ids[i])
    return sorted(((i, len(s), smallest.get(c) if i is not None else None) for i, s, c in zip(ids, sets, comp)), key=str)


def corpus(seed, n=150):
    """Chains of edits, shared passages, copies, and a third of all rows in one group."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    line = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, base = line(40), line(60)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind in (0, 1):
            words = base[:]
            for _ in range(rng.randrange(4)):
                words[rng.randrange(60)] = rng.choice(vocabulary)
        elif kind == 2:
            words = line(rng.randrange(20)) + passage
        elif kind == 3 and rows:
            words = (rng.choice(rows)[1] or "").split()
            words = words[: len(words) - rng.randrange(3)] + line(rng.randrange(3))
        else:
            words = line(rng.choice([0, 1, 2, 3, 4, 30]))
        rows.append((i, rng.choice([" ", "\t", " \n"]).join(words).upper() if rng.random() < 0.2 else " ".join(words), "", ""))
    return rows + [(None, "w1 w2", "", ""), (None, rows[0][1], "", ""), (n, None, "", ""), (n + 1, " \t", "", ""), rows[7], (n + 2, "É é", "", ""), (n + 3, "é é", "", "")]


@pytest.mark.parametrize("seed, size, percent, region", [(1, 4, 85, 3000), (2, 3, 60, 5), (3, 2, 50, 8), (4, 5, 80, 4)])
def test_against_brute_force(spark, seed, size, percent, region):
    rows = corpus(seed)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), size, percent, region=region)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, size, percent)


@pytest.mark.parametrize("seed", range(5))
def test_region_forest_spans_all_links(seed):
    rng = random.Random(seed)
    base = rng.sample(range(10_000), 60)
    sets = []
    for _ in range(80):
        s = set(base) if rng.random() < 0.7 else set(rng.sample(range(10_000), 50))
        for _ in range(rng.randrange(15)):
            s.discard(rng.choice(base))
            s.add(rng.randrange(10_000))
        sets.append(np.array(sorted(s), np.uint64))
    comp = list(range(80))
    for a in range(80):
        for b in range(a):
            c = len(np.intersect1d(sets[a], sets[b]))
            if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
                comp = [comp[b] if x == comp[a] else x for x in comp]
    forest = links_of_region(sets, 80)
    found = list(range(80))
    for a, b in forest:
        found = [found[b] if x == found[a] else x for x in found]
    same = lambda c: {frozenset(i for i in range(80) if c[i] == x) for x in set(c)}
    assert same(found) == same(comp) and len(forest) == 80 - len(set(comp))


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    one = near_duplicates(spark.createDataFrame([(5, "a", "", "")], SCHEMA)).collect()
    assert [tuple(r) for r in one] == [(5, 1, 5)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 1)]
    rng = random.Random(0)
    rng.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def test_class_counts_lose_no_link_and_part_unrelated_sets():
    rng = np.random.default_rng(2)
    sets, truth = [], []
    for n in (1, 30, 790, 810, 3000, 11_990, 12_010, 20_000):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        near = np.unique(np.concatenate([base[: max(1, int(len(base) * 0.9))], rng.integers(0, 2**63, n // 20).astype(np.uint64)]))
        sets += [base, near]
        truth.append((len(sets) - 2, len(sets) - 1))
    forest = near_by_counts([class_counts(s) for s in sets], 80)
    comp = list(range(len(sets)))
    for a, b in forest:
        comp = [comp[b] if x == comp[a] else x for x in comp]
    assert all(comp[a] == comp[b] for a, b in truth)
    assert len({comp[a] for a, _ in truth}) >= len(truth) - 2  # 790 and 810, 11,990 and 12,010 are near in size
