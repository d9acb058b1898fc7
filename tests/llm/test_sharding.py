import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from riskspark.llm.sharding import hilbert_index, hilbert_shards, write_shards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string"


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_unit_steps(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    names = [f"x{i}" for i in range(dims)]
    df = spark.createDataFrame(cells, ", ".join(f"{n} int" for n in names))
    rows = df.withColumn("h", hilbert_index([F.col(n) for n in names], bits)).collect()
    path = [tuple(r)[:-1] for r in sorted(rows, key=lambda r: r["h"])]
    assert sorted(r["h"] for r in rows) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def documents(n):
    rows = []
    for i in range(n):
        copy = i % 3 == 0  # a third of all rows is one text
        text = "same text" if copy else "é" * (i % 40) + str(i)
        rows.append((i, text, ["en", "de", None][i % 3], f"src{i % 7}", len(text), "clash"))
    rows += [(None, None, None, None, None, None), (n, "", "en", "src0", 0, "x"), (n, "", "en", "src0", 0, "x")]
    return rows


def test_runs_have_near_equal_bytes_and_gapless_slots(spark):
    rows = documents(600)
    got = hilbert_shards(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got) == sorted(
        (r[0] is not None, r[0] or 0) for r in rows
    )
    sizes = {r["shard"]: 0 for r in got}
    slots = {s: [] for s in sizes}
    text = {r[0]: (r[1] or "").encode() for r in rows}
    for r in got:
        assert r["size"] == len(text[r["doc_id"]]) + 1
        assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]])
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) == set(range(16))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in got)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["curve"])
    bounds = [(min(c), max(c)) for _, c in sorted(by_shard.items())]
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))


def test_empty_and_single(spark):
    assert hilbert_shards(spark.createDataFrame([], SCHEMA)).count() == 0
    [row] = hilbert_shards(spark.createDataFrame([(1, "x", "en", "s", 1, "c")], SCHEMA)).collect()
    assert (row["size"], row["slot"]) == (2, 0)


def test_written_shards_keep_all_columns(spark, tmp_path):
    docs = spark.createDataFrame(documents(50)[:50], SCHEMA)
    write_shards(docs, hilbert_shards(docs, shards=4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and {*docs.columns, "_shard"} == set(back.columns)


@pytest.mark.parametrize("few", [10_000, 3])
def test_levels_order_and_cuts_against_a_plain_version(spark, monkeypatch, few):
    monkeypatch.setattr("riskspark.llm.sharding.FEW_VALUES", few)
    rows = [(*r[:3], r[3] and f"https://{r[3]}.example.org/a", *r[4:]) for r in documents(90)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    dims, bits, shards = ("lang", "source", "n_chars"), 3, 5
    got = hilbert_shards(df, dims, shards, bits).collect()

    def levels(column):
        known = sorted(r[column] for r in rows if r[column] is not None)
        if column == 4:  # numbers: how many of the quantiles lie below
            cuts = [known[max(0, -(-len(known) * i // 8) - 1)] for i in range(1, 8)]
            return [0 if r[4] is None else sum(c < r[4] for c in cuts) for r in rows]
        before = {v: sum(x < v for x in known) for v in known}
        return [0 if r[column] is None else before[r[column]] * 8 // len(known) for r in rows]

    points = list(zip(range(len(rows)), levels(2), levels(3), levels(4)))
    assert len({p[2] for p in points}) > 4  # sources with a common head are told apart
    placed = spark.createDataFrame(points, "i long, a int, b int, c int")
    curve = dict(placed.select("i", hilbert_index([F.col(c) for c in "abc"], bits).alias("h")).collect())
    likes = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "i long, text string")
    like = dict(likes.select("i", F.xxhash64("text").alias("h")).collect())
    size = [len((r[1] or "").encode()) + 1 for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (curve[i], like[i], rows[i][0] is not None, rows[i][0] or 0, size[i]))
    want, upto, slots = [], 0, {}
    for i in order:
        upto += size[i]
        shard = min(shards - 1, (2 * upto - size[i]) * shards // (2 * sum(size)))
        want.append((str(rows[i][0]), size[i], curve[i], shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
    assert sorted((str(r["doc_id"]), r["size"], r["curve"], r["shard"], r["slot"]) for r in got) == sorted(want)
