"""Removal of long repeated byte strings by a logarithmic family of sparse suffix arrays.

A string of ``length`` bytes counts as repeated when it starts at two places. Of all suffixes of
the texts only those at anchors are indexed: the anchor of a string is the place in it whose next
``depth`` bytes have the smallest hash, so equal strings have their anchors at the same place, and
two of them never meet but in an equal prefix of ``depth`` bytes of two indexed suffixes. An array
is sorted by the hash of those bytes. That is another order than that of the bytes, but equal
prefixes stand side by side in both, and nothing else is ever asked of it.

A new batch of texts becomes an array of its own, which is scanned against all levels that exist:
entries of the batch that meet another one, in it or in a level, and entries of levels that met none
before. Every entry is thus reported once, in the scan in which it first meets another. Before a
further batch comes, levels that have grown to the same size are merged into one of the next, so
n batches are kept in log n arrays, and an entry is rewritten log n times. The family can be
saved and taken up again.

Where a whole span is repeated, so are all its strings. Where it is not, its strings are looked at
in smaller and smaller groups: first those that begin within 16 bytes, then one by one. A group
whose common part is met nowhere else is dropped, a group that is repeated as a whole is done.
Everything is compared by 64-bit hashes of at most 2 length - depth bytes. Strings known to
collide in hashes of this kind, whatever the base, have 2,048 bytes or more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import prefix_hash, span_hash, text_slices, written
from riskspark.session import shared_dir

LENGTH = 400
# From three batches on levels are merged.
BATCHES = 4
GROUPS = (16, 1)
# Bytes of text that one step works on; places in a step fit in PLACE_BITS.
SLICE = 500_000
PLACE_BITS = 22
# Cores of a new batch by which levels are thinned instead of being shuffled with it.
BROADCAST_ROWS = 300_000
# Texts with spans up to this many are known to every task, so that only they are shuffled.
LIKES = 4_000_000
# A core that comes this often among about SAMPLE entries is spread over the tasks.
SAMPLE, OFTEN = 200_000, 50
# Keys with the most rows that are sent to every task; any other holds less than 1/HOT of the rows.
HOT = 2000
ENTRY = "core long, hull long, like long, anchor int, low int, high int"
NAMES = ["core", "hull", "like", "anchor", "low", "high"]


def steps(
    batches: Iterator[pa.RecordBatch], overlap: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int, int]]:
    """(rows, bytes, offsets, start, stop): slices of whole texts, or stretches of one long text.

    What begins from byte ``start`` to before ``stop`` of a long text is the stretch's own; its bytes
    go ``overlap`` bytes into the next one.
    """
    for rows, raw, offsets in text_slices(batches, limit=SLICE):
        if len(offsets) > 2 or len(raw) <= 2 * SLICE:
            yield rows, raw, offsets, 0, len(raw)
            continue
        for at in range(0, len(raw), SLICE):
            own = raw[at : at + SLICE + overlap]
            yield rows, own, np.array([0, len(own)]), at, at + SLICE


def anchors(
    raw: np.ndarray, offsets: np.ndarray, length: int, depth: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Running hash of the bytes; starts of all strings inside one text, and their anchors."""
    run = length - depth + 1
    prefix = prefix_hash(raw)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    starts = np.flatnonzero(np.arange(len(raw)) + length <= ends)
    if not len(starts):
        return prefix, starts, starts
    places = np.arange(len(raw) - depth + 1)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (span_hash(prefix, places, places + depth) & ~low) | places.astype(np.uint64)
    # Smallest key of every run of places: it lies in the end of one block or the start of the next.
    blocks = -(-len(keys) // run)
    padded = np.full(blocks * run, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    padded = padded.reshape(blocks, run)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(behind[starts], ahead[starts + run - 1])
    return prefix, starts, (best & low).astype(np.int64)


def _batch(columns: list, **more) -> pa.RecordBatch:
    core, hull, like, *places = columns
    arrays = [pa.array(core.view(np.int64)), pa.array(hull.view(np.int64)), pa.array(like)]
    arrays += [pa.array(p.astype(np.int32)) for p in places]
    return pa.RecordBatch.from_arrays([*arrays, *more.values()], names=[*NAMES, *more])


def suffix_entries(texts: DataFrame, length: int, depth: int) -> DataFrame:
    """Sparse suffixes of (like, text): core is the hash of an anchor's bytes, hull that of its span.

    ``low`` to ``high`` are the first bytes of the anchor's strings, counted in the text.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets, start, _ in steps(batches, length - 1):
            prefix, starts, at = anchors(raw, offsets, length, depth)
            if not len(starts):
                continue
            text = np.searchsorted(offsets, at, side="right") - 1
            # Strings of one anchor follow one another.
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            last = np.append(first[1:], len(at)) - 1
            at, low, high, text = at[first], starts[first], starts[last], text[first]
            like = rows.column(0).to_numpy(zero_copy_only=False)[text]
            core, hull = span_hash(prefix, at, at + depth), span_hash(prefix, low, high + length)
            base = offsets[text] - start
            yield _batch([core, hull, like, at - base, low - base, high - base])

    return texts.mapInArrow(apply, ENTRY)


def _grouped(texts: DataFrame, length: int, width: int) -> DataFrame:
    """Entries for the strings of (like, text, spans), in groups of ``width`` starts.

    Groups are cut by the distance to the anchor, so equal strings fall into groups whose
    common part is the same.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets, start, stop in steps(batches, 2 * length):
            spans = rows.column(2)
            flat = spans.flatten()
            text = np.repeat(np.arange(len(spans)), np.asarray(spans.value_lengths()))
            anchor, low, high, n = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
            if len(offsets) == 2:  # spans that begin in this stretch; all lie in it
                own = (low >= start) & (low < stop)
                text, anchor, low, high, n = (c[own] for c in (text, anchor, low, high, n))
            # Group numbers from the span's last string (nearest to the anchor) to its first.
            near, far = (anchor - high) // width, (anchor - low) // width
            count = far - near + 1
            row = np.repeat(np.arange(len(text)), count)
            group = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + near[row]
            first = np.maximum(low[row], anchor[row] - group * width - (width - 1))
            last = np.minimum(high[row], anchor[row] - group * width)
            base, prefix = offsets[text[row]] - start, prefix_hash(raw)
            inner = anchor[row] - group * width
            core = span_hash(prefix, base + inner, base + inner - (width - 1) + length)
            hull = span_hash(prefix, base + first, base + last + length)
            like = rows.column(0).to_numpy(zero_copy_only=False)[text[row]]
            yield _batch([core, hull, like, anchor[row], first, last], n=pa.array(n[row].astype(np.int32)))

    return texts.mapInArrow(apply, ENTRY + ", n int")


class SuffixLevels:
    """The family of arrays: (size in batches, table of entries sorted by core in its files)."""

    def __init__(self, levels: list[tuple[int, DataFrame]] | None = None) -> None:
        self.levels = list(levels or [])

    def add(self, array: DataFrame) -> DataFrame:
        """Take in a batch's array; returns the entries that first meet another one by it.

        Two levels of one size are merged before the next batch comes in.
        """
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels.pop(), self.levels.pop()
            order = ["core", "like", "anchor"]  # a hot core may lie in several ranges
            merged = a.unionByName(b).repartitionByRange(*order).sortWithinPartitions(*order)
            self.levels.append((2 * size, written(merged, "suffix-level")))
        met = written(self._scan(array), "suffix-met")
        self.levels.append((1, array))
        return met

    def _scan(self, array: DataFrame) -> DataFrame:
        new = array.withColumn("new", F.lit(True))
        both, total = new, array.count()
        few = total <= BROADCAST_ROWS
        cores = F.broadcast(array.select("core").distinct())
        for _, level in self.levels:
            total += level.count()
            near = level.join(cores, "core", "left_semi") if few else level
            both = both.unionByName(near.withColumn("new", F.lit(False)))
        # Cores met very often, by a sample: each of their entries meets another one. Rows are drawn one
        # by one, as the entries of copies are equal. What is drawn decides the way of a core, not the result.
        share = F.rand(1) * max(1, total // SAMPLE) < 1
        hot = both.where(share).groupBy("core").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= OFTEN)
        hot = written(hot.select("core"), "suffix-hot")
        spread = not hot.isEmpty()
        group = Window.partitionBy("core")
        rest = both.join(F.broadcast(hot), "core", "left_anti") if spread else both
        rest = (
            rest.withColumn("times", F.count(F.lit(1)).over(group))
            .withColumn("before", F.count_if(~F.col("new")).over(group))
            .where((F.col("times") > 1) & (F.col("new") | ((F.col("before") == 1) & (F.col("times") > F.col("before")))))
            .drop("times", "before", "new")
        )
        if not spread:
            return rest
        often = both.join(F.broadcast(hot), "core", "left_semi")
        old = often.where(~F.col("new"))
        alone = old.groupBy("core").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") == 1).select("core")
        first = old.join(F.broadcast(alone), "core", "left_semi")
        return rest.unionByName(often.where("new").unionByName(first).select(rest.columns))

    def save(self, path: str) -> None:
        for number, (size, level) in enumerate(self.levels):
            level.write.parquet(f"{path}/level={number}/size={size}")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SuffixLevels:
        """The levels of a saved family, the oldest first."""
        every = spark.read.option("basePath", path).schema(f"{ENTRY}, level int, size int").parquet(path)
        found = sorted((r["level"], r["size"]) for r in every.select("level", "size").distinct().collect())
        return cls([(size, every.where(F.col("level") == n).drop("level", "size")) for n, size in found])


def kept_by(rows: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """The rows whose key is in (key, times). Those of the most frequent keys need no shuffle."""
    hot = F.broadcast(counts.orderBy(F.desc("times")).limit(HOT).select(key))
    rest = rows.join(hot, key, "left_anti").join(counts.select(key), key, "left_semi")
    return rows.join(hot, key, "left_semi").unionByName(rest)


def meeting(entries: DataFrame) -> DataFrame:
    """Entries whose core another entry has too. Cores are counted before anything is joined."""
    entries = written(entries, "suffix-groups")
    cores = entries.groupBy("core").agg(F.sum("n").alias("times")).where(F.col("times") > 1)
    return kept_by(entries, "core", written(cores, "suffix-cores"))


def _resolve(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(done, open) of meeting entries: done repeat as a whole; open go on in smaller groups.

    Among the open ones stands one entry, with n = 2, for every repeated hull that shares its core
    with an open one.
    """
    place = F.struct("like", "anchor", "low", "high", "core")
    hulls = written(
        met.groupBy("hull").agg(F.sum("n").alias("times"), F.min(place).alias("one")), "suffix-hulls"
    )
    many = F.col("times") > 1
    done = kept_by(met, "hull", hulls.where(many).select("hull", "times"))
    single = hulls.where(~many).select("one.*").withColumn("n", F.lit(1))
    cores = hulls.groupBy(F.col("one.core").alias("core")).agg(F.count_if(many).alias("times"), F.count_if(~many).alias("open"))
    cores = written(cores.where((F.col("open") > 0) & (F.col("times") > 0)).select("core", "times"), "suffix-cores")
    known = kept_by(hulls.where(many).select("one.*"), "core", cores)
    return done.select("like", "low", "high"), single.unionByName(known.withColumn("n", F.lit(2)))


def _attach(rows: DataFrame, spans: DataFrame, how: str = "inner") -> DataFrame:
    """Join rows to a written table of one row per like.

    Only rows that have a partner move: which likes those are is sent to all tasks, up to LIKES of
    them. The spans themselves may be many for one like and are never sent.
    """
    likes = spans.select("like")
    if spans.limit(LIKES + 1).count() > LIKES:
        return rows.join(spans, "like", how)
    likes = F.broadcast(likes)
    found = rows.join(likes, "like", "left_semi").join(spans, "like")
    if how == "inner":
        return found
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in spans.schema.fields if f.name != "like"]
    return found.unionByName(rows.join(likes, "like", "left_anti").select("*", *none))


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """(like, start, end): overlapping and touching ranges of a text as one."""
    by_text = Window.partitionBy("like").orderBy("start", "end")
    before = F.max("end").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    new = (F.col("start") > F.coalesce(before, F.lit(-1))).cast("int")
    return (
        ranges.distinct()
        .withColumn("new", new)
        .withColumn("run", F.sum("new").over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("like", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("run")
    )


def repeated_ranges(texts: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """(like, start, end): maximal runs of bytes covered by repeated strings, per text of (like, text).

    Rows with the same text count each as a place of their own.
    """
    spark = texts.sparkSession
    depth = length // 2
    path = shared_dir(spark, "suffix-arrays")
    (
        suffix_entries(texts, length, depth)
        .withColumn("batch", F.pmod(F.xxhash64("like"), F.lit(batches)))
        .sortWithinPartitions("batch", "core")
        .write.partitionBy("batch")
        .parquet(path)
    )
    arrays = spark.read.schema(ENTRY + ", batch long").parquet(path)
    levels, hits = SuffixLevels(), []
    for number in range(batches):
        hits.append(levels.add(arrays.where(F.col("batch") == number).drop("batch")))
    return ranges_of(texts, hits, length)


def ranges_of(texts: DataFrame, hits: Sequence[DataFrame], length: int) -> DataFrame:
    """(like, start, end) from the entries that scans reported, of any of the (like, text)."""
    met = reduce(DataFrame.unionByName, hits).withColumn("n", F.lit(1))
    found = []
    for width in (None, *GROUPS):
        if width is not None:
            spans = open_.groupBy("like").agg(F.collect_list(F.struct("anchor", "low", "high", "n")).alias("spans"))
            spans = written(spans, "suffix-open")
            joined = _attach(texts, spans).select("like", "text", "spans")
            # A text that stands for a repeated hull may come in several copies.
            met = meeting(_grouped(joined, length, width))
        met = written(met, "suffix-found") if width is not None else met
        done, open_ = _resolve(met)
        found.append(done.select("like", F.col("low").alias("start"), (F.col("high") + length).alias("end")))
    return merged_ranges(reduce(DataFrame.unionByName, found))


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    batches: int = BATCHES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_bytes, removed, kept): per row its size, removed (start, end) runs, and what is left.

    Every byte of a text (as UTF-8) is removed that a string of ``length`` bytes covers which also
    starts at another place, in any row or in the same text. All is judged on the input. ``kept``
    is binary, as a cut may fall inside a character.

    Null texts have no bytes and a null ``kept``. Rows that repeat key or text count each, so copies
    of at least ``length`` bytes go as a whole. Null keys are kept. An empty table gives an
    empty result; other columns are ignored. Texts are told apart by a 64-bit hash. Long texts are
    worked on in overlapping stretches, so the size of a text is bounded by that of a cell alone.
    """
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    body = F.col(f"`{text}`")
    texts = docs.where(F.octet_length(body) >= length).select(F.xxhash64(body).alias("like"), body.alias("text"))
    runs = repeated_ranges(texts, length, batches)
    runs = runs.groupBy("like").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
    runs = written(runs, "suffix-runs")
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(body).alias("like"), body.alias("text"))
    rows = _attach(rows, runs, "left").select("id", "text", "removed")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, offsets in text_slices(batches, limit=SLICE):
            kept = []
            valid = part.column(1).is_valid().to_pylist()
            for i, runs in enumerate(part.column(2).to_pylist()):
                own = raw[offsets[i] : offsets[i + 1]]
                if runs:
                    cuts = [0, *(x for r in runs for x in (r["start"], r["end"])), len(own)]
                    own = np.concatenate([own[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)])
                kept.append(own.tobytes() if valid[i] else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(offsets)), part.column(2), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "removed", "kept"],
            )

    schema = f"id {kind}, n_bytes long, removed array<struct<start:int,end:int>>, kept binary"
    none = F.array().cast("array<struct<start:int,end:int>>")
    return (
        rows.mapInArrow(apply, schema)
        .withColumn("removed", F.coalesce("removed", none))
        .withColumnRenamed("id", key)
    )
