import random
import tempfile
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskspark.llm import suffixes
from riskspark.llm.suffixes import SuffixLevels, ranges_of, remove_repeats, repeated_ranges, steps, suffix_entries

SCHEMA = "doc_id long, text string, like string, n_bytes string"


def brute(rows, length):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = {}
    for b in texts:
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] = seen.get(b[s : s + length], 0) + 1
    out = []
    for (doc_id, t, *_), b in zip(rows, texts):
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, None if t is None else kept))
    return sorted(out, key=str)


def found(df, **options):
    rows = remove_repeats(df, **options).collect()
    gone = lambda r: sum(x["end"] - x["start"] for x in r["removed"])
    out = [(r["doc_id"], r["n_bytes"], gone(r), len(r["removed"]), r["kept"] and bytes(r["kept"])) for r in rows]
    return sorted([(*o[:4], b"" if o[4] is not None and not o[4] else o[4]) for o in out], key=str)


def corpus(seed, alphabet, n=60):
    rng = random.Random(seed)
    piece = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [piece(k) for k in (24, 39, 40, 41, 90, 200)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            text = passages[5]  # a third is one text
        else:
            text = "".join(piece(rng.randrange(60)) + rng.choice(passages)[rng.randrange(3) :] for _ in range(rng.randrange(4)))
        if i % 7 == 0 and rows:
            old = list(rng.choice(rows)[1])
            if old:
                old[rng.randrange(len(old))] = "!"
            text = "".join(old)
        rows.append((i, text, "", ""))
    return rows + [(None, passages[4], "", ""), (None, None, "", ""), (n, "", "", ""), rows[4], (n + 1, "ab" * 100, "", ""), (n + 2, "z" * 41, "", "")]


@pytest.mark.parametrize("seed, alphabet, batches", [(1, "abcdefgh", 4), (2, "ab", 1), (3, "éè日a", 5)])
def test_against_brute_force(spark, seed, alphabet, batches):
    rows = corpus(seed, alphabet)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(df, length=40, batches=batches) == brute(rows, 40)


def test_contract_length(spark):
    rng = random.Random(9)
    body = "".join(rng.choice("abcdefghij ") for _ in range(5000))
    rows = [(1, body, "", ""), (2, "x" + body[100:499] + "y", "", ""), (3, "x" + body[1000:1400] + "y", "", "")]
    rows += [(4, body[2000:2900] + "-" + body[2500:3300], "", ""), (5, "long " * 20_000, "", "")]
    got = {r[0]: r for r in found(spark.createDataFrame(rows, SCHEMA))}
    assert got[2][2:4] == (0, 0) and got[3][2:] == (400, 1, b"xy") and got[5][2:4] == (100_000, 1)
    assert got[4][2:] == (1700, 2, b"-") and got[1][2] == 400 + 1300


ENTRY = "core long, hull long, like long, anchor int, low int, high int"


def test_levels_merge_geometrically(spark):
    levels = SuffixLevels()
    sizes = []
    for i in range(7):
        met = levels.add(spark.createDataFrame([(7, 100 + i, i, 0, 0, 0)], ENTRY))
        sizes.append([s for s, _ in levels.levels])
        # Each entry is reported once: the first with the second, then only the new one.
        assert sorted(r["like"] for r in met.collect()) == [[], [0, 1], [2], [3], [4], [5], [6]][i]
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1], [4, 1, 1], [4, 2, 1]]


@pytest.mark.parametrize("often, few", [(50, 300_000), (3, 0)])
def test_scans_report_every_meeting_entry_once(spark, monkeypatch, often, few):
    """With and without hot cores, thinned and shuffled levels; copies of an entry count each."""
    monkeypatch.setattr("riskspark.llm.suffixes.OFTEN", often)
    monkeypatch.setattr("riskspark.llm.suffixes.BROADCAST_ROWS", few)
    rng = random.Random(often + few)
    batches = [[(rng.choice([1, 1, 1, *range(40)]), 5, 100 * b + i, 0, 0, 0) for i in range(25)] for b in range(5)]
    batches[2] += batches[2][:3]
    levels, got = SuffixLevels(), Counter()
    for b, rows in enumerate(batches):
        if b == 3:
            path = f"{tempfile.mkdtemp(prefix='run-')}/levels"
            levels.save(path)
            levels = SuffixLevels.open(spark, path)
            assert [s for s, _ in levels.levels] == [2, 1]
        got.update(map(tuple, levels.add(spark.createDataFrame(rows, ENTRY)).collect()))
        seen = [r for part in batches[: b + 1] for r in part]
        cores = Counter(r[0] for r in seen)
        assert got == Counter(r for r in seen if cores[r[0]] > 1)


def test_cores_of_many_copies_are_spread(spark, monkeypatch):
    """Copies of a text have equal entries: a sample must not take all of them or none."""
    hot, write = [], suffixes.written

    def told(df, purpose):
        out = write(df, purpose)
        if purpose == "suffix-hot":
            hot.append(sorted(r["core"] for r in out.collect()))
        return out

    monkeypatch.setattr(suffixes, "written", told)
    monkeypatch.setattr(suffixes, "SAMPLE", 800)
    rows = [(core, 5, 7, 300 * core, 0, 0) for core in range(8) for _ in range(400)]
    rows += [(100 + i // 2, 5, 100 + i, 0, 0, 0) for i in range(200)] + [(300 + i, 5, 300 + i, 0, 0, 0) for i in range(50)]
    met = SuffixLevels().add(spark.createDataFrame(rows, ENTRY))
    assert Counter(map(tuple, met.collect())) == Counter(rows[:3400])
    assert hot == [list(range(8))]


def test_a_batch_added_to_reopened_levels(spark):
    rows, length = corpus(11, "abcdef"), 40
    df = spark.createDataFrame(rows, SCHEMA).where("text IS NOT NULL")
    texts = df.select(F.xxhash64("text").alias("like"), "text")
    parts = [texts.where(F.pmod("like", F.lit(5)) == n) for n in range(5)]
    levels, hits = SuffixLevels(), []
    for part in parts[:4]:
        hits.append(levels.add(suffix_entries(part, length, length // 2)))
    path = f"{tempfile.mkdtemp(prefix='run-')}/levels"
    levels.save(path)
    hits.append(SuffixLevels.open(spark, path).add(suffix_entries(parts[4], length, length // 2)))

    def ranges(hits):
        return sorted(map(tuple, ranges_of(texts, hits, length).collect()))

    whole = sorted(map(tuple, repeated_ranges(texts, length, 1).collect()))
    assert ranges(hits) == whole
    assert all(ranges([h for h in hits if h is not left]) != whole for left in hits[-1:])


def test_a_long_text_is_taken_in_stretches(spark):
    rng = random.Random(8)
    body = "".join(rng.choices("abcdefgh", k=1_700_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([body])], names=["like", "text"])
    assert [start for *_, start, _ in steps(iter([batch]), 399)] == [0, 500_000, 1_000_000, 1_500_000]
    # Passages across the ends of stretches, at both ends of the text, and one byte too short.
    cuts = [(0, 400), (499_800, 500_400), (999_700, 1_000_900), (1_200_000, 1_200_399), (1_499_999, 1_500_400), (1_699_600, 1_700_000)]
    rows = [(1, body, "", ""), (2, "".join(f"<{body[a:b]}>" for a, b in cuts), "", "")]
    got = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [tuple(r) for r in got[1]["removed"]] == [c for c in cuts if c[1] - c[0] >= 400]
    assert bytes(got[2]["kept"]).decode() == "<>" * 3 + f"<{body[1_200_000:1_200_399]}>" + "<>" * 2


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert found(spark.createDataFrame([(1, "a", "", "")], SCHEMA)) == [(1, 1, 0, 0, b"a")]


def test_the_operator_merges_levels_by_default(spark, monkeypatch):
    sizes, add = [], SuffixLevels.add

    def told(levels, array):
        met = add(levels, array)
        sizes.append([s for s, _ in levels.levels])
        return met

    monkeypatch.setattr(SuffixLevels, "add", told)
    rows = corpus(1, "ab")
    assert found(spark.createDataFrame(rows, SCHEMA), length=40) == brute(rows, 40)
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1]]
