"""Toxicity: a linear classifier whose scores do not move when identity terms are swapped.

Features are the words of a text and the byte 4- and 5-grams inside them, present or absent. The
loss is the log loss of labelled texts, plus a weight times the squared change of the margin
between each text that names a group and its counterfactual, in which every identity term is
replaced by the next term of its group. A term that stands in many toxic texts thus cannot earn
a weight that its counterparts lack, and neutral mentions are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import lower_ascii, mix, prefix_hash, span_hash, text_slices, word_spans, written

GRAMS = (4, 5)
# Labelled rows used for fitting, at most about this many, picked by the hash of their id.
SAMPLE = 10_000
FEATURES = 1_024
# Labelled texts that must hold a feature before it is considered.
SUPPORT = 5
THRESHOLD = 0.7
# Terms that stand for groups; each is swapped with the next one in its line.
IDENTITY = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("immigrants", "natives", "refugees", "citizens"),
    ("immigrant", "native", "refugee", "citizen"),
    ("disabled", "able", "blind", "deaf"),
    ("old", "young", "elderly"),
)

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CODES = lower_ascii()
_LOOKUP_BITS = 22


def features(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, text number) of all words, then of all grams inside words, by length."""
    starts, ends, text = word_spans(raw, offsets, _IS_WORD)
    prefix = prefix_hash(raw, _CODES)
    yield span_hash(prefix, starts, ends), text
    lengths = ends - starts
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    end_of, text_of = np.repeat(ends, lengths), np.repeat(text, lengths)
    for n in GRAMS:
        fits = inside + n <= end_of
        at = inside[fits]
        yield mix(span_hash(prefix, at, at + n) + np.uint64(n)), text_of[fits]


def word_hash(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(span_hash(prefix_hash(raw, _CODES), np.array([0]), np.array([len(raw)]))[0])


def swapper(groups: Sequence[Sequence[str]]) -> Callable[[str], str]:
    """Replace every identity term by the next of its group, in lower case."""
    following = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    if not following:
        return lambda text: text
    find = re.compile(r"\b(?:" + "|".join(sorted(following, key=len, reverse=True)) + r")\b", re.IGNORECASE)
    return lambda text: find.sub(lambda m: following[m[0].lower()], text)


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def lookup(self) -> np.ndarray:
        table = np.zeros(1 << _LOOKUP_BITS, bool)
        table[self.hashes & np.uint64(len(table) - 1)] = True
        return table

    def hits(self, raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text number, feature number), each once."""
        last = np.uint64(len(table) - 1)
        texts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for hashes, text in features(raw, offsets):
            maybe = np.flatnonzero(table[hashes & last])
            h = hashes[maybe]
            at = np.minimum(np.searchsorted(self.hashes, h), max(0, len(self.hashes) - 1))
            real = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
            texts.append(text[maybe][real])
            found.append(at[real])
        both = np.unique(np.concatenate(texts) * max(1, len(self.hashes)) + np.concatenate(found))
        return np.divmod(both, max(1, len(self.hashes)))

    def scores(self, raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
        texts, found = self.hits(raw, offsets, table)
        margin = np.bincount(texts, weights=self.weights[found], minlength=len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def _bytes_of(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    encoded = [t.encode() for t in texts]
    return np.frombuffer(b"".join(encoded), np.uint8), np.concatenate([[0], np.cumsum([len(e) for e in encoded])])


def minimise(
    x: np.ndarray, y: np.ndarray, pairs: np.ndarray, swapped: np.ndarray, penalty: float, ridge: float, steps: int
) -> np.ndarray:
    """Weights, bias last: mean log loss + penalty * mean squared margin change + ridge.

    ``pairs`` are the rows of x that have a counterfactual, ``swapped`` those counterfactuals.
    Adam over all rows, from zero, so the result depends on the data only.
    """
    w = np.zeros(x.shape[1] + 1)
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w[-1] = np.log(rate / (1 - rate))
    change = (swapped - x[pairs]) if len(pairs) else None
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        at = w[:-1].astype(x.dtype)
        wrong = 1 / (1 + np.exp(-np.clip(x @ at + w[-1], -50, 50))) - y
        slope = np.append(wrong.astype(x.dtype) @ x / len(y) + ridge * w[:-1], wrong.mean())
        if change is not None:
            slope[:-1] += 2 * penalty * ((change @ at) @ change) / len(pairs)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    n_features: int = FEATURES,
    identity: Sequence[Sequence[str]] = IDENTITY,
    penalty: float = 1.0,
    ridge: float = 1e-4,
    steps: int = 400,
) -> Model:
    """Fit on labelled rows: about ``sample`` of them, picked by the hash of the key.

    The sample's size bounds what the driver gathers: a row of at most ``n_features`` numbers
    for each labelled text. Features are the ``n_features`` that tell the classes apart best,
    and the identity terms. Rows with a null key or label are left out, null texts count as
    empty, repeated labels count each. Without labelled rows the model answers 0.5, with one
    class its share.
    """
    marked = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")
    )
    n = marked.count()
    if n > sample:
        marked = marked.where(F.pmod(F.xxhash64("id"), F.lit(n)) < sample)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = written(rows.join(marked, "id").select("y", "text").repartition(8), "toxic-sample")
    sizes = dict(rows.groupBy("y").count().collect())
    if len(sizes) < 2:
        only = next(iter(sizes), None)
        return Model(np.zeros(0, np.uint64), np.zeros(0), {None: 0.0, 0: -6.0}.get(only, 6.0))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, offsets in text_slices(batches):
            y = part.column(0).to_numpy(zero_copy_only=False)
            for hashes, number in features(raw, offsets):
                order = np.lexsort((number, hashes))
                h, i = hashes[order], number[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (i[1:] != i[:-1])
                h, toxic = h[new], y[i[new]] > 0
                start = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
                if len(h):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h[start].view(np.int64)),
                            pa.array(np.diff(np.append(start, len(h)))),
                            pa.array(np.add.reduceat(toxic.astype(np.int64), start)),
                        ],
                        names=["hash", "n", "n1"],
                    )

    total, total1 = sum(sizes.values()), sum(v for k, v in sizes.items() if k > 0)
    rate = total1 / total
    best = (
        rows.mapInArrow(held, "hash long, n long, n1 long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
        .where(F.col("n") >= SUPPORT)
        # Distance of the toxic count from what chance gives, in standard deviations.
        .withColumn("z", (F.col("n1") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate)))
        .orderBy(F.desc(F.abs("z")), "hash")
        .limit(n_features)
        .select("hash")
        .collect()
    )
    terms = np.array([word_hash(t) for g in identity for t in g], np.uint64)
    hashes = np.unique(np.concatenate([np.array([r[0] for r in best], np.int64).view(np.uint64), terms]))
    model = Model(hashes, np.zeros(len(hashes)), 0.0)
    swap = swapper(identity)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.lookup()
        for part, raw, offsets in text_slices(batches):
            texts = part.column(1).to_pylist()
            twins = [swap(t) for t in texts]
            own = _per_text(*model.hits(raw, offsets, table), len(texts))
            other = _per_text(*model.hits(*_bytes_of(twins), table), len(texts))
            named = [t.lower() != w.lower() for t, w in zip(texts, twins, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(own, pa.list_(pa.int32())),
                    pa.array([o if m else None for o, m in zip(other, named, strict=True)], pa.list_(pa.int32())),
                ],
                names=["y", "own", "twin"],
            )

    sparse = rows.mapInArrow(encode, "y int, own array<int>, twin array<int>").toArrow().to_pydict()
    # Rows in one order, however the tasks ended.
    order = sorted(range(len(sparse["y"])), key=lambda i: (sparse["y"][i], sparse["own"][i], sparse["twin"][i] or []))
    y = np.array([sparse["y"][i] > 0 for i in order], float)
    x = _dense([sparse["own"][i] for i in order], len(hashes))
    pairs = np.array([k for k, i in enumerate(order) if sparse["twin"][i] is not None], np.int64)
    swapped = _dense([sparse["twin"][order[k]] for k in pairs], len(hashes))
    w = minimise(x, y, pairs, swapped, penalty, ridge, steps)
    return Model(hashes, w[:-1], float(w[-1]))


def _per_text(texts: np.ndarray, found: np.ndarray, n: int) -> list[list[int]]:
    cut = np.searchsorted(texts, np.arange(n + 1))
    return [found[a:b].tolist() for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _dense(rows: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for i, found in enumerate(rows):
        out[i, found] = 1
    return out


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row, by its whole text; null and empty texts get the model's base score.

    Null and repeated keys stay as they are, an empty table gives an empty result, and other
    columns are ignored.
    """
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value.lookup()
        for part, raw, offsets in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sent.value.scores(raw, offsets, table))], names=["id", "score"]
            )

    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(apply, f"id {kind}, score double").withColumnRenamed("id", key)


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all columns, whose score stays under the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value.lookup()
        for part, raw, offsets in text_slices(batches, text):
            yield part.filter(pa.array(sent.value.scores(raw, offsets, table) < threshold))

    return docs.mapInArrow(apply, docs.schema)
