import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskspark.llm.packing import WordIds, blocks, pack, plan, sequences

tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, piece string, ids string, length int"


def expand(counts, capacity):
    """The sequences of a plan as lists of (offset, length)."""
    runs, n = plan(counts, capacity)
    bins = [[] for _ in range(n)]
    for length in (n for n in counts if counts[n]):
        own = sorted(r for r in runs if r.length == length)
        ends = [r.first for r in own[1:]] + [counts[length]]
        for run, end in zip(own, ends, strict=True):
            for k in range(end - run.first):
                bins[run.sequence + k // run.each].append((run.offset + k % run.each * length, length))
    for own in bins:
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    assert Counter(n for own in bins for _, n in own) == Counter({k: v for k, v in counts.items() if v})
    return bins


def most_pairs(sizes, capacity):
    if len(sizes) < 2:
        return 0
    rest = most_pairs(sizes[1:], capacity)
    for i in range(1, len(sizes)):
        if sizes[0] + sizes[i] <= capacity:
            rest = max(rest, 1 + most_pairs(sizes[1:i] + sizes[i + 1 :], capacity))
    return rest


def piece_by_piece(counts, capacity):
    """The same rule on single pieces: longest first; pairs, then the smallest gap that is wide enough."""
    sizes = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    large, gaps = [n for n in sizes if 3 * n > capacity], []
    while large:
        a = large.pop(0)
        partner = next((i for i, b in enumerate(large) if a + b <= capacity), None)
        gaps.append(capacity - a - (large.pop(partner) if partner is not None else 0))
    for n in [n for n in sizes if 3 * n <= capacity]:
        fitting = [i for i, g in enumerate(gaps) if g >= n]
        if fitting:
            gaps[min(fitting, key=lambda i: gaps[i])] -= n
        else:
            gaps.append(capacity - n)
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(40))
def test_plan_follows_the_rule_piece_by_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 12, 30, 64])
    counts = {rng.randint(1, capacity): rng.randint(0, 9) for _ in range(rng.randint(1, 14))}
    bins = expand(counts, capacity)
    assert sorted(capacity - sum(n for _, n in b) for b in bins) == piece_by_piece(counts, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_large_pieces_make_the_most_pairs(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(11, 29) for _ in range(9)]
    bins = expand(Counter(sizes), 30)
    assert max(map(len, bins)) <= 2
    assert len(sizes) - len(bins) == most_pairs(sizes, 30)


def test_few_sequences_and_a_short_plan():
    rng = random.Random(5)
    counts = Counter(min(4096, int(rng.lognormvariate(5.5, 1.3)) + 1) for _ in range(50_000))
    bins = expand(counts, 4096)
    assert len(bins) <= 1.002 * sum(n * c for n, c in counts.items()) / 4096 + 1
    runs, n = plan({k: 10**9 * c for k, c in counts.items()}, 4096)
    assert len(runs) < 40_000 and n >= 10**9
    assert plan({}, 8) == ([], 0)
    for wrong in ({0: 1}, {9: 1}):
        with pytest.raises(ValueError):
            plan(wrong, 8)


def test_ids_equal_whole_texts():
    whole = Tokenizer.from_file(PATH)
    words = ["The", "étude,", "don't", "x2", "<|endoftext|>", "a<|endoftext|>b", "ß", "İI", "́a", "é", "\t", "…", "it's!",
             "漢字", "Σας", "!!!", "--", "", "\x1c", " q", "naïve.", "ÿÿ", "'s", "_", "a_b", "ﬁ"]
    encode = WordIds(open(PATH, encoding="utf-8").read())
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", "\n", "  ", " \n"]) for _ in range(rng.randint(0, 30)))
        expected = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encode([text])[0] == expected
        assert b"".join(encode([b])[0] for b in blocks(text, 20)) == expected


def documents():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta,", "gamma"]) for _ in range(rng.randint(0, 90))), "x", None, 1) for i in range(90)]
    rows += [(200 + i, "one same text", "x", "y", 2) for i in range(60)]  # more than a third
    return rows + [(None, "no key", "x", "y", 2), (7, None, None, None, None), (7, "", "x", "y", 0), (7, "", "x", "y", 0)]


def test_pack_against_plain_version(spark):
    whole, rows, capacity = Tokenizer.from_file(PATH), documents(), 32
    expected = Counter()
    for key, text, *_ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), capacity):
            own = ids[start : start + capacity]
            expected[key, start // capacity, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    placed = pack(df, PATH, capacity, keep_ids=True).persist()
    got = placed.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    lengths = Counter(r["length"] for r in got)
    assert len({r["sequence_id"] for r in got}) == plan(lengths, capacity)[1]
    for row in sequences(placed).collect():
        own = sorted((r["offset"], r["length"], bytes(r["ids"]), r["doc_id"]) for r in got if r["sequence_id"] == row["sequence_id"])
        assert [r[0] for r in own] == list(np.cumsum([0, *(r[1] for r in own[:-1])])) == row["starts"]
        assert np.array(row["ids"], "<u4").tobytes() == b"".join(r[2] for r in own)
        assert row["keys"] == [r[3] for r in own]
    placed.unpersist()


def test_lengths_around_the_capacity(spark):
    text = {n: " ".join(["a"] * n) for n in (2, 3, 4, 7, 8)}  # with the end id one more
    df = spark.createDataFrame([(n, t) for n, t in text.items()], "doc_id long, text string")
    got = {(r["doc_id"], r["piece"]): r["length"] for r in pack(df, PATH, 4).collect()}
    assert got == {(2, 0): 3, (3, 0): 4, (4, 0): 4, (4, 1): 1, (7, 0): 4, (7, 1): 4, (8, 0): 4, (8, 1): 4, (8, 2): 1}


def test_very_long_text_and_empty_table(spark):
    rng = random.Random(2)
    text = " ".join(rng.choice(["lorem", "ipsum.", "dolor"]) for _ in range(800_000))
    ids = [*Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, 1]
    df = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = pack(df, PATH).where(F.col("doc_id") == 1).orderBy("piece").collect()
    assert [r["length"] for r in got] == [len(ids[a : a + 4096]) for a in range(0, len(ids), 4096)]
    assert [r["ids_crc32"] for r in got] == [
        zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes()) for a in range(0, len(ids), 4096)
    ]
    assert pack(df.limit(0), PATH).count() == 0


def test_every_pair_of_two_lengths():
    for a, b in combinations(range(1, 13), 2):
        for x, y in ((1, 1), (3, 2), (5, 7)):
            expand({a: x, b: y}, 12)


def test_known_words_are_not_learnt_again_when_too_many_are_kept(monkeypatch):
    model = open(PATH, encoding="utf-8").read()
    encode, learnt = WordIds(model), []
    monkeypatch.setattr("riskspark.llm.packing.KNOWN_WORDS", 7)
    learn = encode._learn
    monkeypatch.setattr(encode, "_learn", lambda words: (learnt.extend(words), learn(words)))
    texts = ["ash beech cedar", "dogwood elm fir", "ash elm fir ginkgo holly", "ash elm yew"]
    whole = Tokenizer.from_str(model)
    for text in texts:
        assert encode([text])[0] == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert Counter(learnt) == Counter(" ".join(texts).split()) - Counter({"ash": 2, "elm": 2, "fir": 1})
