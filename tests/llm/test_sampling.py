import itertools
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from riskspark.llm import sampling
from riskspark.llm.common import text_slices
from riskspark.llm.pieces import MARK, load, marked_words, vocabulary
from riskspark.llm.sampling import Ids, PieceTable, decode, encode_slice, sample_encode

SCHEMA = "doc_id long, text string, rank string, pieces string"
SMALL = vocabulary(
    [(MARK, 1), ("a", 2), ("b", 3), ("ab", 4), ("ba", 5), (MARK + "a", 6), ("aba", 7)], tuple(range(10, 266))
)


@pytest.fixture(scope="module")
def pieces():
    return load()


def all_paths(v, text, theta=1.0):
    """Every segmentation with its probability, by plain enumeration."""
    score = dict(zip(v.pieces, v.scores))
    number = dict(zip(v.pieces, v.ids))

    def cut(s):
        if not s:
            return [((), 0.0)]
        out = []
        for n in range(1, len(s) + 1):
            if s[:n] in score:
                out += [((number[s[:n]], *p), w + theta * score[s[:n]]) for p, w in cut(s[n:])]
        if s[0] not in score:
            out += [((*v.unknown(s[0]), *p), w + theta * v.unknown_score) for p, w in cut(s[1:])]
        return out

    paths = cut("".join(marked_words(text)))
    total = math.log(sum(math.exp(w) for _, w in paths))
    return {p: w - total for p, w in paths}


def draw(v, text, n, k, theta=0.3):
    seeds = np.random.default_rng(1).integers(0, 2**63, n).astype(np.uint64)
    table, ids = PieceTable(v), Ids(v)
    out = [[] for _ in range(n)]
    s = encode_slice([text] * n, seeds, table, ids, k, theta)
    for i, t in enumerate(s.text):
        assert s.rank[i] == len(out[t]) + 1
        found = tuple(s.ids[s.bounds[i] : s.bounds[i + 1]].tolist())
        out[t].append((found, s.log_prob[i], s.noisy[i], s.inclusion[i]))
    return out


def test_runs_of_unknown_characters_without_byte_pieces():
    v = vocabulary([(MARK, 1), ("a", 2)])
    s = encode_slice(["cca", "c", "c"], np.arange(3).astype(np.uint64), PieceTable(v), Ids(v), 1, 1.0)
    assert [s.ids[a:b].tolist() for a, b in zip(s.bounds, s.bounds[1:])] == [[1, 0, 2], [1, 0], [1, 0]]


@pytest.mark.parametrize("text", ["abab", "ab ba", "cab"])
def test_paths_and_probabilities(text):
    want = all_paths(SMALL, text, 0.3)
    for own in draw(SMALL, text, 50, 3):
        assert len({p for p, *_ in own}) == len(own) == min(3, len(want))
        assert [x[2] for x in own] == sorted((x[2] for x in own), reverse=True)
        for path, logp, _, inclusion in own:
            assert logp == pytest.approx(want[path]) and 0 < inclusion <= 1


def test_sampling_without_replacement_has_the_right_law():
    """First and second path against exact probabilities of drawing in turn; estimates unbiased."""
    text, n = "abab", 20_000
    exact = {p: math.exp(w) for p, w in all_paths(SMALL, text, 0.3).items()}
    got = draw(SMALL, text, n, 2)
    firsts = Counter(own[0][0] for own in got)
    pairs = Counter((own[0][0], own[1][0]) for own in got)
    for p, q in exact.items():
        assert abs(firsts[p] / n - q) < 4.5 * math.sqrt(q * (1 - q) / n) + 1e-9
    for (p, q), (r, s) in itertools.permutations(exact.items(), 2):
        want = q * s / (1 - q)
        assert abs(pairs[p, r] / n - want) < 4.5 * math.sqrt(want * (1 - want) / n) + 1e-9
    estimate = np.mean([sum(math.exp(x[1]) / x[3] for x in own) for own in got])
    assert estimate == pytest.approx(1, abs=0.02)


def test_three_samples_have_the_right_law():
    text, n = "aba b", 20_000
    exact = {p: math.exp(w) for p, w in all_paths(SMALL, text, 0.3).items()}
    triples = Counter(tuple(x[0] for x in own) for own in draw(SMALL, text, n, 3))
    for (a, p), (b, q), (c, r) in itertools.permutations(exact.items(), 3):
        want = p * q / (1 - p) * r / (1 - p - q)
        assert abs(triples[a, b, c] / n - want) < 5 * math.sqrt(want * (1 - want) / n) + 1e-9


def test_rows_do_not_depend_on_their_batch(spark, pieces):
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choices("abcdeé", k=rng.randrange(9))) for _ in range(rng.randrange(30))), "", "") for i in range(200)]
    rows += [(None, "null key", "", ""), (300, None, "", ""), (301, "", "", ""), rows[5], (302, "▁a  b\n☃ ", "", ""), (303, "x" * 3000, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: str(r)
    one = sorted(sample_encode(df.repartition(1), pieces, k=3).collect(), key=key)
    many = sorted(sample_encode(df.repartition(7), pieces, k=3).collect(), key=key)
    close = lambda a, b: a[:3] == b[:3] and np.allclose(a[3:6], b[3:6], rtol=1e-6)
    assert len(one) == len(many) and all(close(a, b) for a, b in zip(one, many))
    assert all(r["decodes"] for r in one)
    by_key = Counter(r["doc_id"] for r in one)
    assert by_key[300] == 0 and by_key[301] == 1 and by_key[5] == 6 and by_key[None] == 3
    assert sample_encode(df, pieces, seed=1).where("doc_id = 303").first()["pieces"] != (
        sample_encode(df, pieces, seed=2).where("doc_id = 303").first()["pieces"]
    )
    assert sample_encode(spark.createDataFrame([], SCHEMA), pieces).count() == 0


def test_round_trip(spark, pieces):
    rows = [(i, t, "", "") for i, t in enumerate(["", "a", " two  spaces ", "tab\t\U0001f600 é", "long " * 5000])]
    docs = spark.createDataFrame(rows, SCHEMA)
    back = decode(sample_encode(docs, pieces, k=2), pieces)
    text = {i: t for i, t, *_ in rows}
    found = back.collect()
    assert {r["doc_id"] for r in found} == set(text) and all(r["text"] == text[r["doc_id"]] for r in found)


def test_a_slice_takes_little_memory(pieces):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 12))) for _ in range(40_000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(600)]
    table, ids = PieceTable(pieces), Ids(pieces)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    for rows, _, _ in text_slices(iter([batch]), limit=sampling.SLICE):
        encode_slice(rows.column(0).to_pylist(), np.arange(rows.num_rows, dtype=np.uint64), table, ids, 2, 1.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
