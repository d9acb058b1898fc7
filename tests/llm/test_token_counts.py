import random
import struct

import pytest

from riskspark.llm.pieces import MARK, load, marked_words, vocabulary
from riskspark.llm.token_counts import Counter, token_counts

SCHEMA = "doc_id long, text string, score string"


@pytest.fixture(scope="module")
def pieces():
    return load()


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    """One protobuf field: bytes, an int or a float."""
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def tokenizer(v):
    """The library's own unigram tokenizer with the same pieces and scores."""
    from sentencepiece import SentencePieceProcessor

    by_id = {i: (p, s, 1) for p, s, i in zip(v.pieces, v.scores, v.ids)}
    by_id |= {i: (f"<0x{b:02X}>", 0.0, 6) for b, i in enumerate(v.byte_ids)}
    by_id[0] = ("<unk>", 0.0, 2)
    for i in range(max(by_id) + 1):
        by_id.setdefault(i, (f"<s{i}>", 0.0, 3))
    body = b"".join(
        field(1, field(1, by_id[i][0].encode()) + field(2, by_id[i][1]) + field(3, by_id[i][2])) for i in sorted(by_id)
    )
    trainer = field(3, 1) + field(35, int(bool(v.byte_ids))) + field(40, 0)
    normalizer = field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1)
    return SentencePieceProcessor(model_proto=body + field(2, trainer) + field(3, normalizer))


TEXTS = [
    "", " ", "   ", "a", "Hello  world\n a", "  x ﬁ  ", "▁▁a ▁", "tab\tand\x00zero", "\U0001f600\U0001f600 éß",
    "thth" * 300, "世界" * 20, "a" * 3000, "mixed 123,456.78 (e.g. ☃☃☃)",
]


def test_counts_equal_the_tokenizer(pieces):
    library, counter = tokenizer(pieces), Counter(pieces)
    rng = random.Random(1)
    syllables = ["th", "er", "ing", "é", "ou", "x", "\n", ".", "  ", " ", " ", "▁", "龘", "9"]
    texts = TEXTS + ["".join(rng.choice(syllables) for _ in range(rng.randrange(200))) for _ in range(500)]
    for text in texts:
        assert counter.text(text)[1] == len(library.encode(text)), text


def test_counts_without_byte_pieces():
    v = vocabulary([(MARK, 1), ("a", 2), ("ab", 3), ("b", 4), (MARK + "a", 5)])
    library, counter = tokenizer(v), Counter(v)
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("ab c") for _ in range(rng.randrange(12)))
        assert counter.text(text)[1] == len(library.encode(text)), text


def test_best_score_against_all_segmentations():
    v = vocabulary([(MARK, 1), ("a", 2), ("b", 3), ("ab", 4), ("ba", 5), ("aba", 6), (MARK + "ab", 7)], tuple(range(10, 266)))
    score_of = dict(zip(v.pieces, v.scores))

    def best(s):
        if not s:
            return 0.0
        steps = [score_of[s[:n]] + best(s[n:]) for n in range(1, len(s) + 1) if s[:n] in score_of]
        if s[0] not in score_of:
            steps.append(v.unknown_score + best(s[1:]))
        return max(steps)

    for text in ["abab", "baab ab", "c a", "abcba"]:
        assert Counter(v).text(text)[0] == best("".join(marked_words(text)))


def test_words_join_to_the_text():
    for text in TEXTS:
        assert "".join(marked_words(text)) == ((MARK + text.replace(" ", MARK)) if text else "")


def test_rows(spark, pieces):
    rows = [(1, "Hello world", "x"), (1, "Hello world", "x"), (None, "a", "x"), (2, None, "x"), (3, "", "x"), (4, "word " * 40_000, "x")]
    got = token_counts(spark.createDataFrame(rows, SCHEMA), pieces).collect()
    library = tokenizer(pieces)
    want = sorted((str(i), len(library.encode(t or ""))) for i, t, _ in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == want
    assert token_counts(spark.createDataFrame([], SCHEMA), pieces).count() == 0


def test_a_piece_over_a_space_is_refused():
    with pytest.raises(ValueError):
        vocabulary([("a" + MARK + "b", 1)])
