"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

How many pieces have which length is all that a packing depends on, and that is one count for each
length up to the capacity, however large the corpus is. The plan is made from those counts, for
whole runs of like sequences at a time:

- Lengths above a third of the capacity fit at most twice into a sequence. Going down from the
  longest, each takes the longest partner that still fits, which gives the most pairs.
- Smaller pieces, longest first, go where they leave the smallest gap, and open a new sequence
  only where no gap is wide enough.

Pieces are then numbered within their length, and number and length name the place.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import deque
from collections.abc import Iterator, Mapping
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskspark.llm.common import text_slices, written

CAPACITY = 4096
END_ID = 1
# Distinct words whose ids a worker keeps, new ones that it looks up in one call, and code points of
# a long text that it splits at a time. Bytes of text whose distinct words are found together.
KNOWN_WORDS = 1_000_000
AT_ONCE = 200
BLOCK = 1 << 20
SLICE = 6_000_000
# A word of letters that no normal form changes, and signs that end it. Neither apostrophes nor
# angle brackets are among them, as those begin contractions and special tokens.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:;=-@\[-`{-~]*)")


class WordIds:
    """Ids of texts as little-endian 32-bit words, by a tokenizer that drops white space.

    White space ends every word for such a tokenizer, so texts are cut at spaces and line feeds and
    each distinct word is looked up once. Equal to one call on the whole text.
    """

    def __init__(self, model: str) -> None:
        self.tokenizer = Tokenizer.from_str(model)
        self.ends = {i for w, i in self.tokenizer.get_vocab(False).items() if w.endswith("</w>")}
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn_parts(self, new: list[str]) -> None:
        """Ids of words and runs of signs, from one text that holds them all."""
        ids = self._encode(" ".join(new))
        ends = [n + 1 for n, i in enumerate(ids) if i in self.ends]
        if len(ends) == len(new) and ends[-1] == len(ids):
            raw = np.array(ids, "<u4").tobytes()
            for word, a, b in zip(new, [0, *ends], ends, strict=False):
                self.parts[word] = raw[4 * a : 4 * b]
        else:
            for word in new:
                self.parts[word] = np.array(self._encode(word), "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        split, new = [], set()
        for word in words:
            found = SIMPLE.fullmatch(word)
            if found:
                letters, signs = found[1].lower(), found[2]
                split.append((word, letters, signs))
                new.update(p for p in (letters, signs) if p not in self.parts)
            else:
                self.words[word] = np.array(self._encode(word), "<u4").tobytes()
        parts = list(new)
        for at in range(0, len(parts), AT_ONCE):
            self._learn_parts(parts[at : at + AT_ONCE])
        for word, letters, signs in split:
            self.words[word] = self.parts[letters] + self.parts[signs]

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. When too many are kept, only those of this call stay."""
        found = list(map(self.words.get, words))
        new = [w for w, ids in zip(words, found, strict=True) if ids is None]
        if not new:
            return found
        if len(self.words) + len(new) > KNOWN_WORDS:
            self.words = {w: ids for w, ids in zip(words, found, strict=True) if ids is not None}
        if len(self.parts) > KNOWN_WORDS:
            self.parts = {"": b""}
        self._learn(new)
        return [self.words[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        spaced = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
        words = pc.split_pattern(spaced, " ")
        coded = words.flatten().dictionary_encode()
        found = self._known(coded.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(found), "<u4")
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        code = coded.indices.to_numpy()
        each = count[code]
        ends = np.cumsum(each)
        first = (np.cumsum(count) - count)[code] - (ends - each)
        raw = ids[np.repeat(first, each) + np.arange(each.sum())].tobytes()
        cuts = (4 * np.append(0, ends)[words.offsets.to_numpy()]).tolist()
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_encoders: dict[int, WordIds] = {}


def encoder(model: str) -> WordIds:
    """The worker's encoder, which outlives a task."""
    name = zlib.crc32(model.encode())
    if name not in _encoders:
        _encoders[name] = WordIds(model)
    return _encoders[name]


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """The text in blocks of about ``size`` code points, cut at spaces."""
    at = 0
    while len(text) - at > size:
        to = text.rfind(" ", at, at + size)
        if to < 0:
            to = text.find(" ", at + size)
        if to < 0:
            break
        yield text[at:to]
        at = to + 1
    yield text[at:] if at else text


class Run(NamedTuple):
    """Pieces ``first`` and on of a length: ``each`` to a sequence, from ``sequence`` and ``offset`` on."""

    length: int
    first: int
    sequence: int
    each: int
    offset: int


class _Packing:
    def __init__(self, counts: Mapping[int, int], capacity: int) -> None:
        self.capacity, self.left = capacity, dict(counts)
        self.placed: dict[int, int] = {}
        self.runs: list[Run] = []
        self.gaps: list[int] = []
        self.with_gap: dict[int, deque[tuple[int, int]]] = {}
        self.sequences = 0

    def open(self, number: int) -> int:
        self.sequences += number
        return self.sequences - number

    def leave(self, gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in self.with_gap:
                insort(self.gaps, gap)
            self.with_gap.setdefault(gap, deque()).append((first, number))

    def take(self, gap: int) -> tuple[int, int]:
        own = self.with_gap[gap]
        found = own.popleft()
        if not own:
            del self.with_gap[gap]
            del self.gaps[bisect_left(self.gaps, gap)]
        return found

    def put(self, length: int, sequence: int, number: int, each: int, offset: int) -> None:
        """``each`` pieces into each of ``number`` sequences."""
        first = self.placed.get(length, 0)
        self.runs.append(Run(length, first, sequence, each, offset))
        self.placed[length] = first + number * each
        self.left[length] -= number * each

    def large(self, lengths: list[int]) -> None:
        """Pairs, longest first, each with the longest partner that fits."""
        free = sorted(lengths)
        while free:
            a = free[-1]
            at = bisect_right(free, self.capacity - a) - 1
            if at >= 0 and free[at] == a and self.left[a] == 1:
                at -= 1
            if at < 0:
                number, filled = self.left[a], a
                first = self.open(number)
                self.put(a, first, number, 1, 0)
            elif free[at] == a:
                number, filled = self.left[a] // 2, 2 * a
                first = self.open(number)
                self.put(a, first, number, 2, 0)
            else:
                b = free[at]
                number, filled = min(self.left[a], self.left[b]), a + b
                first = self.open(number)
                self.put(a, first, number, 1, 0)
                self.put(b, first, number, 1, a)
                if not self.left[b]:
                    del free[at]
            if not self.left[a]:
                free.pop()
            self.leave(self.capacity - filled, first, number)

    def small(self, length: int) -> None:
        while self.left[length]:
            at = bisect_left(self.gaps, length)
            if at == len(self.gaps):
                fit = self.capacity // length
                number = -(-self.left[length] // fit)
                self.leave(self.capacity, self.open(number), number)
                continue
            gap = self.gaps[at]
            first, number = self.take(gap)
            fit = gap // length
            full = min(number, self.left[length] // fit)
            offset = self.capacity - gap
            if full:
                self.put(length, first, full, fit, offset)
                self.leave(gap - fit * length, first, full)
            rest = self.left[length] if full < number else 0
            if rest:
                self.put(length, first + full, 1, rest, offset)
                self.leave(gap - rest * length, first + full, 1)
                full += 1
            self.leave(gap, first + full, number - full)


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Runs that place ``counts[length]`` pieces of each length, and the number of sequences.

    Neither the number of runs nor the work depends on the counts, only on the number of lengths.
    """
    packing = _Packing({n: c for n, c in counts.items() if c}, capacity)
    if any(n < 1 or n > capacity for n in packing.left):
        raise ValueError("lengths lie between 1 and the capacity")
    if packing.left.get(capacity):
        number = packing.left[capacity]
        packing.put(capacity, packing.open(number), number, 1, 0)
    packing.large([n for n in packing.left if capacity < 3 * n and n < capacity])
    for n in sorted((n for n in packing.left if 3 * n <= capacity), reverse=True):
        packing.small(n)
    return packing.runs, packing.sequences


def token_pieces(
    docs: DataFrame, model: str, capacity: int, end_id: int, key: str, text: str, keep_ids: bool
) -> DataFrame:
    """(id, piece, start, length, crc, part, nth[, ids]), nth counted in each part and length."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = F.col(f"`{text}`")
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    names = ["id", "piece", "start", "length", "crc", "part", "nth"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, size = encoder(shared.value), TaskContext.get().partitionId(), 4 * capacity
        end = np.array([end_id], "<u4").tobytes()
        seen = np.zeros(capacity + 1, np.int64)
        for rows, _, offsets in text_slices(batches, "text", SLICE):
            texts = rows.column(1).to_pylist()
            out = [[], [], [], [], [], []]
            whole = encode([t or "" for t in texts]) if len(texts) > 1 or offsets[-1] <= 2 * BLOCK else None
            for i, t in enumerate(texts):
                number, held = 0, b""
                found = [whole[i]] if whole is not None else (encode([b])[0] for b in blocks(t or ""))
                for raw in (*found, end):
                    held = held + raw if held else raw
                    last = raw is end
                    while len(held) > size or (held and last):
                        cut = held[:size]
                        held = held[size:]
                        n = len(cut) // 4
                        for column, value in zip(out, (i, number, n, zlib.crc32(cut), seen[n], cut), strict=True):
                            column.append(value)
                        seen[n] += 1
                        number += 1
            at, piece, length, crc, nth = (np.array(c, np.int64) for c in out[:5])
            columns = [
                rows.column(0).take(pa.array(at)),
                pa.array(piece.astype(np.int32)),
                pa.array(piece * capacity),
                pa.array(length),
                pa.array(crc),
                pa.array(np.full(len(at), part, np.int32)),
                pa.array(nth),
            ]
            if keep_ids:
                columns.append(pa.array(out[5], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids"][: len(columns)])

    schema = f"id {kind}, piece int, start long, length long, crc long, part int, nth long"
    rows = docs.select(F.col(f"`{key}`").alias("id"), body.alias("text"))
    return rows.mapInArrow(apply, schema + (", ids binary" if keep_ids else ""))


def pack(
    docs: DataFrame,
    tokenizer: str | Path,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset[, ids]): every piece in its place.

    A document is its ids and ``end_id``; one longer than the capacity is cut into pieces of the
    capacity, of which the last may be shorter. ``tokenizer`` is the path of a file whose
    tokenizer drops white space between words. With ``keep_ids`` the ids come along as
    little-endian 32-bit words, for ``sequences``.

    Null and empty texts are the end id alone. Rows that repeat a key or a text are documents of
    their own; null keys are kept. Pieces of one length are placed in the order of the tasks that
    made them, so equal texts may change places between runs. An empty table gives an empty result;
    other columns are ignored. A long text is worked on in blocks cut at spaces; a word without
    any space is one block however long it is.

    One pass over the texts. What shuffles is narrow: one row per piece, and one count per task
    and length. At most ``capacity`` counts come to the driver.
    """
    if capacity < 1:
        raise ValueError("a sequence holds one token or more")
    model = Path(tokenizer).read_text(encoding="utf-8")
    pieces = written(token_pieces(docs, model, capacity, end_id, key, text, keep_ids), "pack-pieces")
    counts = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    # One row for each length.
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(by_length, capacity)
    table = np.array(sorted(runs), np.int64).reshape(-1, len(Run._fields))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    numbered = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("before"))
    more = ["ids"] if keep_ids else []
    names = ["id", "piece", "start", "length", "crc", *more]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, each, offset = shared.value.T
        # Lengths and runs in one sorted array, as a length's runs follow one another.
        shift = np.int64(1 << 45)
        keys = length * shift + first
        for rows in batches:
            own, rank = (rows.column(rows.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, own * shift + rank, side="right") - 1
            turn = rank - first[at]
            columns = [rows.column(rows.schema.get_field_index(c)) for c in names]
            columns += [pa.array(sequence[at] + turn // each[at]), pa.array(offset[at] + turn % each[at] * own)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    kind = pieces.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, crc long, "
    schema += ("ids binary, " if keep_ids else "") + "sequence_id long, offset long"
    placed = numbered.select(*names, "rank").mapInArrow(place, schema)
    return placed.withColumnsRenamed({"id": key, "crc": "ids_crc32"})


def sequences(placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """(sequence_id, ids, keys, starts): the packed sequences, from ``pack(keep_ids=True)``.

    ``ids`` is an array of ids without gaps; ``keys`` and ``starts`` say whose each piece is and
    where it begins. No more than the capacity meets in one row.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            parts = rows.column(1)
            raw = [b"".join(own) for own in parts.to_pylist()]
            ends = np.cumsum([0, *(len(r) // 4 for r in raw)])
            ids = pa.array(np.frombuffer(b"".join(raw), "<u4").astype(np.int32))
            columns = [rows.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids), *rows.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["sequence_id", "ids", "keys", "starts"])

    # Structs keep null keys, and sort by offset, which is never the same twice.
    one = F.struct("offset", F.col("ids"), F.col(f"`{key}`").alias("key"))
    rows = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(one)).alias("parts"))
    rows = rows.select(
        "sequence_id", F.col("parts.ids").alias("ids"), F.col("parts.key").alias("keys"), F.col("parts.offset").alias("starts")
    )
    kind = placed.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    return rows.mapInArrow(apply, f"sequence_id long, ids array<int>, keys array<{kind}>, starts array<long>")
