"""Exact top-k search by inner product over integer vectors, by MaxScore.

A dimension is a query term; a shard's vectors with a component of the query's sign there are
the term's postings, and the largest product with one of them is its score bound. Terms are
taken by falling bound. Those whose bounds together stay under the score to beat are
non-essential: a vector that only they would bring in cannot win, so only essential postings
are traversed. What was met there is probed in the remaining terms as long as its score so far
plus the bounds still to come reaches the score to beat.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
# Shards whose scores might not fit in 64 bits are worked on with integers of any size.
WIDEST = 1 << 62
# Queries that are sent to every task at once.
QUERY_BLOCK = 16_384
# Vectors scored together; a shard for the score bounds.
SHARD = 8_192
PROBE = 8


def integer_rows(ids: pa.Array, vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Ids and floor(scale * x) of the usable rows; shorter vectors are filled with zeros.

    Components that do not fit in 64 bits come as Python integers. ``scale`` is a power of two.
    """
    n = len(vectors)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0)).astype(np.int64)
    raw = np.asarray(pc.cast(vectors.flatten(), pa.float64()).fill_null(np.nan))
    usable = np.isfinite(raw)
    row = np.repeat(np.arange(n), lengths)
    keep = np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid())
    keep[row[~usable]] = False
    own = usable & keep[row]
    large = bool(len(raw)) and bool((np.abs(raw[own]) >= WIDEST / scale).any())
    if large:
        values = np.array([math.floor(v * scale) if abs(v) < 2.0**52 else int(v) * scale for v in raw[own].tolist()], object)
    else:
        values = np.floor(raw[own] * scale).astype(np.int64)
    out = np.zeros((n, int(lengths.max(initial=0))), values.dtype)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row[own], place[own]] = values
    return np.asarray(ids.fill_null(0)).astype(np.int64)[keep], out[keep]


def _size(values: np.ndarray) -> int:
    """The largest absolute value."""
    return max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0)))) if values.size else 0


class Best:
    """The k best of each query so far: by falling score, then by id."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.found: list[tuple[np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids
        ]

    def to_beat(self, q: int) -> int | None:
        scores = self.found[q][0]
        return int(scores[-1]) if len(scores) == self.k else None

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        other = ids != self.query_ids[q]
        scores = np.concatenate([self.found[q][0], scores[other]])
        ids = np.concatenate([self.found[q][1], ids[other]])
        if scores.dtype == object:
            order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[: self.k]
            self.found[q] = scores[order], ids[order]
            return
        if len(scores) > 4 * self.k:  # a cheaper cut before the sort; ties at the edge stay
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[scores >= edge], ids[scores >= edge]
        order = np.lexsort((ids, -scores))[: self.k]
        self.found[q] = scores[order], ids[order]

    def search(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take in one shard."""
        width = max(self.queries.shape[1], vectors.shape[1])
        queries = np.pad(self.queries, ((0, 0), (0, width - self.queries.shape[1])))
        vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
        kind = object if width * _size(queries) * _size(vectors) >= WIDEST else np.int64
        queries, vectors = queries.astype(kind), vectors.astype(kind)
        head = min(len(ids), 16 * self.k)
        columns = np.ascontiguousarray(vectors[head:].T)
        first = queries @ vectors[:head].T
        if len(ids) > head:
            highest, lowest = columns.max(axis=1, initial=0), columns.min(axis=1, initial=0)
        for q, query in enumerate(queries):
            self.add(q, first[q], ids[:head])
            if len(ids) == head:
                continue
            goal = self.to_beat(q)
            bound = np.maximum(query * highest, query * lowest)
            terms = np.argsort(-bound, kind="stable")
            rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)  # rest[j]: of terms j and later
            essential = width if goal is None else int(np.argmax(rest < goal)) if (rest < goal).any() else width
            scores = np.zeros(columns.shape[1], kind)
            met = np.full(columns.shape[1], goal is None or essential == width)
            for d in terms[:essential]:
                part = query[d] * columns[d]
                scores += part
                met |= part > 0
            here = np.flatnonzero(met)
            scores = scores[here]
            for j in range(essential, width, PROBE):
                competitive = scores + rest[j] >= goal
                here, scores = here[competitive], scores[competitive]
                probed = terms[j : j + PROBE]
                scores = scores + query[probed] @ columns[np.ix_(probed, here)]
            if goal is not None:
                here, scores = here[scores >= goal], scores[scores >= goal]
            self.add(q, scores, ids[head:][here])

    def rows(self) -> Iterator[pa.RecordBatch]:
        counts = [len(s) for s, _ in self.found]
        if any(_size(s) >= 2**63 for s, _ in self.found if s.dtype == object):
            raise OverflowError("a score of the best does not fit in 64 bits")
        if sum(counts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(self.query_ids, counts)),
                    pa.array(np.concatenate([i for _, i in self.found])),
                    pa.array(np.concatenate([s for s, _ in self.found]).astype(np.int64)),
                ],
                names=["query_id", "vec_id", "score"],
            )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of each query vector.

    Components x count as floor(256 * x) and the score is the integer inner product; ties go
    to the smaller id. Rows with a null id, a null vector, or a null or non-finite component take no
    part. Components of any size count exactly; a score among the best that does not fit in 64 bits
    raises OverflowError. Shorter vectors count as filled with
    zeros, an empty one as all zeros. A repeated query id asks once, by one of its rows; repeated
    candidate rows each count, but none that carries the query's id. With fewer than k others all
    are returned; an empty table gives an empty result. Other columns are ignored.

    Queries go to all tasks in blocks of bounded size; each block reads the table once and each
    task returns its k best per query, so the merge moves k rows per query and task.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"))
    asked = vectors.where(is_query).select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v")
    )
    asked = asked.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    blocks = max(1, -(-asked.count() // block))
    results = []
    for number in range(blocks):
        own = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number)
        found = own.dropDuplicates(["id"]).toArrow().combine_chunks()
        ids, vecs = (found.column(c).combine_chunks() for c in ("id", "v"))
        sent = spark.sparkContext.broadcast(integer_rows(ids, vecs))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            best = Best(*sent.value, k)
            for batch in batches:
                for at in range(0, batch.num_rows, SHARD):
                    part = batch.slice(at, SHARD)
                    best.search(*integer_rows(part.column(0), part.column(1)))
            yield from best.rows()

        results.append(rows.mapInArrow(search, "query_id long, vec_id long, score long"))
    merged = results[0]
    for more in results[1:]:
        merged = merged.unionByName(more)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        merged.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
