import re

from conftest import SF
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_overlaps
from test_jaccard import brute as brute_groups
from test_pii import plain

import corpus_pipeline as pipeline
from riskspark.llm import toxicity
from riskspark.llm.common import written
from riskspark.llm.pieces import load
from riskspark.llm.sampling import decode

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def with_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [
        (None, "null id, mail a.b@example.org", "en", "s", 5),
        (10_001, None, None, None, None),
        (10_002, "", "en", "s", 0),
        (10_003, "said twice", "en", "s", 1),
        (10_003, "said twice", "en", "s", 1),
        (10_003, "the same id with another text", "en", "s", 1),
    ]
    return docs.unionByName(spark.createDataFrame(odd, docs.schema))


def test_each_stage_against_its_plain_version(spark):
    docs = written(with_odd_rows(spark), "test")
    rows = lambda df: sorted(map(tuple, df.select(COLUMNS).collect()), key=str)
    names = [name for name, _ in pipeline.STAGES]
    assert len(names) == 5
    tables = [docs]
    for _, stage in pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], SF), "test"))
    raw, clean, single, apart, safe, tokens = tables
    assert all(t.columns == COLUMNS for t in tables[:-1])

    # 1: what scores under the threshold stays, nothing else.
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    bad = {r["doc_id"] for r in toxicity.score(docs, model).where("score >= 0.7").collect()}
    assert rows(clean) == [r for r in rows(raw) if r[0] not in bad]

    # 2: one row of each group.
    before = rows(clean)
    numbered = [(None if r[0] is None else i, r[1]) for i, r in enumerate(before)]
    group = {i: c for i, _, c in brute_groups(numbered, 5, 80) if i is not None}
    like = {r["text"]: r["like"] for r in clean.select("text", F.xxhash64("text").alias("like")).collect()}
    place = lambda r: (r[0], like[r[1]])
    smallest = {}
    for i, c in group.items():
        smallest[c] = min(smallest.get(c, place(before[i])), place(before[i]))
    want = {r for i, r in enumerate(before) if r[0] is None or place(r) == smallest[group[i]]}
    assert rows(single) == sorted(want, key=str) and len(want) < len(before)

    # 3: no ten-word window of the benchmark, and every other row.
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = [n > 0 for _, _, n, _ in brute_overlaps(rows(single), items)]
    assert rows(apart) == [r for r, hit in zip(rows(single), hits) if not hit] and any(hits)

    # 4: the same rows; every pattern is gone, and texts without any stay as they were.
    old = {r[0]: r for r in rows(apart) if r[0] is not None}
    new = {r[0]: r for r in rows(safe) if r[0] is not None}
    assert old.keys() == new.keys() and safe.count() == apart.count()
    for key, (_, text, *_) in new.items():
        assert text is None or not any(plain(text).values())
        if old[key][1] is None or not any(plain(old[key][1]).values()):
            assert new[key][1] == old[key][1]
        assert new[key][4] == (None if text is None else len(text))

    # 5: the pieces spell the texts.
    back = decode(tokens, load()).collect()
    assert {r["doc_id"] for r in back} == {r[0] for r in rows(safe) if r[1] is not None}
    texts = {r[0]: r[1] for r in rows(safe) if r[0] != 10_003}
    assert all(r["text"] == texts[r["doc_id"]] for r in back if r["doc_id"] in texts)


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    words = [f"w{i}" for i in range(60)]
    first, near = " ".join(words), " ".join([*words[:59], "x"])
    rows = [(1, first), (7, near), (7, "a clean text that is like no other one at all"), (9, "another one"), (9, "another one"), (None, first)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.drop_near_copies(spark, docs, SF)
    assert got.columns == COLUMNS
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted([rows[0], rows[2], rows[3], rows[5]], key=str)


def test_run_gives_the_last_stage(spark):
    got = pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "rank", "pieces", "log_prob", "inclusion"]
    assert re.match("array<int>", dict(got.dtypes)["pieces"]) and got.where("rank = 1").count() > 100
