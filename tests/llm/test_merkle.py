import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm.merkle import TOP, Manifest, build_manifest, missing, prove

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, pos string, chunk int"


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    key, _, lang, source, n, *_ = row
    cells = [key, source, lang, n, text]
    return hashed(*("-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells))


def climb(nodes, fan):
    """The root over some nodes, and each node's siblings on the way."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, places, strict=True):
            run = range(at // fan * fan, min(at // fan * fan + fan, len(nodes)))
            path.append(([nodes[i] for i in run if i < at], [nodes[i] for i in run if i > at]))
        nodes = [hashed(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
        places = [at // fan for at in places]
    return nodes[0], paths


def brute(rows, changed, fan):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(r, r[1]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fan) for g in names]
    root, above = climb([t[0] for t in trees], fan)
    out = Counter()
    for name, (subroot, paths), high in zip(names, trees, above, strict=True):
        for (*_, leaf, row), path in zip(sorted(groups[name], key=lambda x: x[:3]), paths, strict=True):
            node = leaf_of(row, changed(row))
            for left, right in path + high:
                node = hashed(*left, node, *right)
            proof = "".join(s for left, right in path + high for s in left + right)
            out[row[0], leaf, subroot, proof, node] += 1
    return root, out


def documents(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = "en" if i % 3 == 0 else rng.choice(["de", "é", "", None, "zz", *(f"l{k}" for k in range(12))])
        text = rng.choice(["Same Text", "", None, f"Text {i}", "ÄÖ x"])
        rows.append((rng.randrange(10**6), text, lang, rng.choice(["a", None]), rng.choice([5, None]), "x", "y", 3))
    rows += [(None, "No key", "en", None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows + [(5, "Twice", "en", "a", 1, "x", "y", 1)] * 2 + [(5, "Other", "en", "a", 1, "x", "y", 1)] + rows[:1]


def lowered(row):
    return row[1] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])


@pytest.mark.parametrize("n, fan, chunk", [(400, 8, 37), (150, 2, 8), (30, 3, 1000)])
def test_against_brute_force(spark, n, fan, chunk):
    rows = documents(n, n)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    manifest = build_manifest(df, claims={"text": F.translate("text", upper, lower)}, where=third, fan=fan)

    def changed(row):
        from zlib import crc32

        return lowered(row) if row[0] is not None and crc32(str(row[0]).encode()) % 3 == 0 else row[1]

    root, expected = brute(rows, changed, fan)
    assert manifest.root == root
    got = prove(manifest, chunk=chunk).collect()
    # Rows of one key and equal leaves are interchangeable, and so are their claims.
    assert Counter(map(tuple, got)) == expected
    assert any(r["folded"] == root for r in got) and any(r["folded"] != root for r in got)
    assert Counter((r["doc_id"], r["leaf"]) for r in got) == Counter((r[0], leaf_of(r, r[1])) for r in rows)


def test_proofs_of_some_leaves_of_a_stored_manifest(spark, tmp_path):
    rows = documents(300, 1)
    manifest = build_manifest(spark.createDataFrame(rows, SCHEMA))
    manifest.write(str(tmp_path / "manifest"))
    manifest = Manifest.read(spark, str(tmp_path / "manifest"))
    root, expected = brute(rows, lambda r: r[1], 8)
    some = manifest.leaves.where(F.pmod(F.xxhash64("leaf"), F.lit(10)) == 0)
    got = prove(manifest, some, chunk=64).collect()
    assert 5 < len(got) == some.count()
    assert not Counter(map(tuple, got)) - expected
    assert all(r["folded"] == root for r in got)
    # A digest stands for the proof.
    short = {(r["doc_id"], r["leaf"]): r["proof"] for r in prove(manifest, some, digests=True).collect()}
    assert all(short[r["doc_id"], r["leaf"]] == hashed(r["proof"]) for r in got)


@pytest.mark.parametrize("seed", range(30))
def test_missing_nodes_are_enough_and_all_needed(seed):
    rng = random.Random(seed)
    fan, size = rng.choice([2, 3, 8]), rng.randint(1, 200)
    have = np.array(rng.sample(range(size), rng.randint(1, size)))
    asked = {(level, p) for _, level, pos in missing(0, have, size, fan) for p in pos.tolist()}
    known, needed = set(have.tolist()), set()
    level, n = 0, size
    while n > 1:
        above = {p // fan for p in known}
        runs = {i for a in above for i in range(a * fan, min(a * fan + fan, n))}
        needed |= {(level, i) for i in runs - known}
        known, level, n = above, level + 1, -(-n // fan)
    assert asked == needed


def test_one_row_and_none(spark):
    row = (3, "Only", "en", None, 4, "", "", 0)
    one = build_manifest(spark.createDataFrame([row], SCHEMA))
    leaf = leaf_of(row, "Only")
    assert one.root == leaf
    assert [tuple(r) for r in prove(one).collect()] == [(3, leaf, leaf, "", leaf)]
    none = build_manifest(spark.createDataFrame([], SCHEMA))
    assert none.root is None and prove(none).count() == 0
    assert none.nodes.where(F.col("tree") != TOP).count() == 0
