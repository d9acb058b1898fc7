"""Helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import shared_dir

# Bytes of text that one numpy step works on. Every step holds some tens of times as much.
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back.

    The read part cuts lineage, so a lost executor costs at most the tasks it was running, and
    what a function or a range partitioning decided once stays decided.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_rows(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on (id, like); a null id equals a null id."""
    right = right.withColumnsRenamed({"id": "_id2", "like": "_like2"})
    match = F.col("id").eqNullSafe(F.col("_id2")) & (F.col("like") == F.col("_like2"))
    return left.join(right, match, how).drop("_id2", "_like2")


# Ids up to this many are sent to every task instead of shuffling the texts to them.
FEW_IDS = 1_000_000


def sent_if_few(df: DataFrame, limit: int = FEW_IDS) -> DataFrame:
    """A written table, to be broadcast if it has at most ``limit`` rows; else joins shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of slices of at most ``limit`` bytes of text, or of one longer text.

    ``bytes`` is a view of the UTF-8 of the slice's texts, one after another; text i is
    ``bytes[offsets[i]:offsets[i + 1]]``. A null text has no bytes.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if texts.null_count:
            texts = texts.fill_null("")
        if texts.type != pa.large_string():
            texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        n = len(texts)
        if n == 0:
            continue
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            to = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
            to = min(n, max(to, at + 1))
            own = ends[at : to + 1]
            yield batch.slice(at, to - at), raw[own[0] : own[-1]], own - own[0]
            at = to


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(10, (n - 1).bit_length())
            self.up, self.down = (self._row(base, size) for base in (_BASE, _INVERSE))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _row(base: int, size: int) -> np.ndarray:
        row = np.full(size, base, np.uint64)
        row[0] = 1
        return np.cumprod(row, dtype=np.uint64)


_powers = Powers()


def prefix_hash(raw: np.ndarray, codes: np.ndarray = BYTE_CODES) -> np.ndarray:
    """Running polynomial hash H with H[j] - H[i] fixed by bytes i..j-1 and their place i."""
    up, _ = _powers.to(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(codes[raw] * up[: len(raw)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes start..end-1, whatever their place."""
    _, down = _powers.to(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def word_spans(
    raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the maximal runs of word bytes; none crosses a text."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = is_word[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, side="right") - 1


def lower_ascii() -> np.ndarray:
    """Byte codes in which A-Z hash as a-z."""
    codes = BYTE_CODES.copy()
    codes[65:91] = codes[97:123]
    return codes

