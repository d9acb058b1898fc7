"""Exact join of documents by the Jaccard similarity of their word n-grams.

The distance 1 - similarity is a metric. Documents are first cut into the Voronoi regions of the
pivots {s}, one for each n-gram s: a document that holds s is nearer to {s} than one that does
not, and the rarest n-gram is the nearest. A partner within the join distance may lack some of a
document's n-grams, but not more than n - ceil(t n), so the window of a document is its that
many + 1 rarest ones: it is copied to their regions, and every linked pair meets in one.
Regions with the same smallest document are one region.

Fixed pivots, the classes of n-grams by hash, then thin the regions: documents whose counts in
the classes differ by more than a link allows cannot link. What stays near by all counts in a region
of n-grams is joined into one new region, before any set is moved: a document then lies in one
region only, with all that it may link with, or in none.

Inside a region documents are pivots. With all distances to a few pivots known, two documents
can only be linked if their distances to every pivot differ by no more than the join distance.
Regions above a size are cut so, across the cluster and again and again: by distance to a pivot
into rings as wide as the join distance, each with a copy of the next ring, which is its window.
What remains too large after that (all documents equally far from all pivots) is cut into blocks
whose pairs are compared one by one. Regions report a spanning forest of the links, not all of
them: copies and near copies link to one another through it, and no component is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import (
    lower_ascii,
    mix,
    prefix_hash,
    sent_if_few,
    span_hash,
    text_slices,
    word_spans,
    written,
)
from riskspark.llm.graph import components

_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, *range(9, 14)]] = False
_CODES = lower_ascii()

# Counters of the frequency sketch that orders n-grams. Any order gives the same links; a good
# one puts what many documents share last.
SKETCH = 1 << 20
CHUNK = 1 << 12
# Documents of a region that one task compares, and how often a larger region is cut by a pivot.
REGION = 3_000
ROUNDS = 4
PIVOTS = 8
# Hash classes whose n-gram counts are compared before sets are: more of them for larger sets, as
# counts of unrelated sets differ by about the root of both numbers. (set size from, classes)
CLASSES = ((0, 64), (800, 1024), (12_000, 8192))


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; a text of fewer words is one n-gram."""
    starts, ends, text = word_spans(raw, offsets, _IS_WORD)
    words = span_hash(prefix_hash(raw, _CODES), starts, ends)
    n = len(offsets) - 1
    first = np.searchsorted(text, np.arange(n + 1))
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    grams = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i, factor in enumerate(factors):
        grams += words[i : i + len(grams)] * factor
    grams = mix(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            whole = (words[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([whole])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def needed(n: int, percent: int) -> int:
    """n-grams that a partner must share with a document of n."""
    return -(-percent * n // 100)


def _sizes_and_sketch(docs: DataFrame, size: int) -> DataFrame:
    """Per row (id, n, s1, s2), the size and a fingerprint of its set; per task the sketch."""
    kind = docs.schema["id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        id_type = None
        names = ["id", "n", "s1", "s2", "chunk", "counts"]
        for rows, raw, offsets in text_slices(batches):
            sets = shingles(raw, offsets, size)
            together = np.concatenate(sets)
            sketch += np.bincount((together & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            id_type, m = rows.column(0).type, len(sets)
            marks = [[mix(s ^ np.uint64(salt)).sum(dtype=np.uint64) for s in sets] for salt in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in marks],
                    pa.nulls(m, pa.int32()),
                    pa.nulls(m, pa.list_(pa.int64())),
                ],
                names=names,
            )
        if id_type is not None:
            chunks = sketch.reshape(-1, CHUNK)
            own = np.flatnonzero(chunks.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(own), id_type),
                    *[pa.nulls(len(own), pa.int64())] * 3,
                    pa.array(own.astype(np.int32)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(own) + 1, dtype=np.int32) * CHUNK), pa.array(chunks[own].ravel())
                    ),
                ],
                names=names,
            )

    return docs.mapInArrow(apply, f"id {kind}, n long, s1 long, s2 long, chunk int, counts array<long>")


def _windows(docs: DataFrame, size: int, percent: int, sketch) -> DataFrame:
    """Per row its rarest n-grams, as many as a linked partner cannot lack all of, and its class counts."""
    kind = docs.schema["id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for rows, raw, offsets in text_slices(batches):
            found, counted = [], []
            for s in shingles(raw, offsets, size):
                counted.append(class_counts(s).tobytes())
                keep = len(s) - needed(len(s), percent) + 1 if len(s) else 0
                rare = np.lexsort((s, counts[(s & np.uint64(SKETCH - 1)).astype(np.int64)]))[:keep]
                found.append(s[rare].view(np.int64))
            bounds = np.append(0, np.cumsum([len(f) for f in found])).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), grams, pa.array(counted, pa.binary())], names=["id", "grams", "counts"]
            )

    return docs.mapInArrow(apply, f"id {kind}, grams array<long>, counts binary")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """All columns but the text, and the set as 64-bit hashes."""
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept) + ", grams binary"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in text_slices(batches):
            sets = [s.tobytes() for s in shingles(raw, offsets, size)]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[: len(kept)], pa.array(sets, pa.binary())], names=[*kept, "grams"]
            )

    return docs.select(*kept, "text").mapInArrow(apply, schema)


def links_of_region(sets: list[np.ndarray], percent: int, own: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets, as index pairs.

    ``own``: where given, only pairs that have one set on each side count (a pair of blocks).
    """
    m = len(sets)
    n = np.array([len(s) for s in sets], np.int64)
    comp = np.arange(m)
    links: list[tuple[int, int]] = []
    # Local numbers of the n-grams that at least two sets hold; the others meet nothing.
    _, local, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), n)
    shared = times[local] > 1
    local, owner = local[shared], owner[shared]
    cut = np.searchsorted(owner, np.arange(m + 1))
    held = np.zeros(len(times), bool)

    def common(x: int, others: np.ndarray) -> np.ndarray:
        mine = local[cut[x] : cut[x + 1]]
        held[mine] = True
        if len(others) * 4 > m:
            run = np.append(0, np.cumsum(held[local]))
            out = (run[cut[1:]] - run[cut[:-1]])[others]
        else:
            out = np.array([np.count_nonzero(held[local[cut[y] : cut[y + 1]]]) for y in others], np.int64)
        held[mine] = False
        return out

    def join(x: int, others: np.ndarray, shared_with: np.ndarray) -> None:
        linked = 100 * shared_with >= percent * (n[x] + n[others] - shared_with)
        if own is not None:
            linked &= own[others] != own[x]
        for y in others[linked]:
            if comp[y] != comp[x]:
                links.append((x, int(y)))
                comp[comp == comp[y]] = comp[x]

    distances = []
    everyone = np.arange(m)
    pivots = set(range(0, m, max(1, m // PIVOTS))) if m > 2 * PIVOTS else set()
    for x in sorted(pivots):
        c = common(x, everyone)
        distances.append(1 - c / (n[x] + n - c))
        other = everyone[everyone != x]
        join(x, other, c[other])
    far = np.stack(distances) if distances else np.zeros((0, m))
    width = 1 - percent / 100 + 1e-9
    for x in range(m - 1):
        if x in pivots:
            continue
        later = np.arange(x + 1, m)
        near = (comp[later] != comp[x]) & (100 * np.minimum(n[later], n[x]) >= percent * np.maximum(n[later], n[x]))
        if len(far):
            near &= (np.abs(far[:, x + 1 :] - far[:, x : x + 1]) <= width).all(axis=0)
        later = later[near]
        if len(later):
            join(x, later, common(x, later))
    return links


def class_counts(s: np.ndarray) -> np.ndarray:
    """How many hashes of a sorted set lie in each class; classes are equal runs of hashes."""
    classes = max(c for n, c in CLASSES if len(s) >= n)
    shift = np.uint64(64 - (classes.bit_length() - 1))
    found = np.bincount((s >> shift).astype(np.int64), minlength=classes)
    return np.minimum(found, 65_535).astype(np.uint16)


def near_by_counts(
    counts: list[np.ndarray], percent: int, sides: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets whose class counts a link's difference would allow.

    A link leaves at most (n + m)(1 - t) / (1 + t) n-grams that only one of both holds, and counts
    cannot differ by more than that in all. Pairs are compared in as many classes as both have.
    """
    m = len(counts)
    width = np.array([len(c) for c in counts])
    total = np.array([c.sum(dtype=np.int64) for c in counts])
    levels = []
    for _, classes in CLASSES:
        own = np.flatnonzero(width >= classes)
        folded = [counts[i].reshape(classes, -1).sum(axis=1, dtype=np.int32) for i in own]
        row = np.full(m, -1)
        row[own] = np.arange(len(own))
        levels.append((row, np.array(folded, np.int32).reshape(len(own), classes)))
    comp = np.arange(m)
    forest: list[tuple[int, int]] = []
    for x in range(m - 1):
        later = np.arange(x + 1, m)[comp[x + 1 :] != comp[x]]
        if sides is not None:
            later = later[sides[later] != sides[x]]
        for row, folded in levels:
            if row[x] < 0 or not len(later):
                break
            both = later[row[later] >= 0]
            apart = np.abs(folded[row[both]] - folded[row[x]]).sum(axis=1)
            far = both[apart * (100 + percent) > (total[both] + total[x]) * (100 - percent)]
            later = later[~np.isin(later, far)]
        for y in later:
            if comp[y] != comp[x]:
                forest.append((x, int(y)))
                comp[comp == comp[y]] = comp[x]
    return forest


def _candidates(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that span all documents of (region, side, id, counts) that may link."""
    kind = members.schema["id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(region: list) -> list[tuple]:
            if len(region) < 2:
                return []
            counts = [np.frombuffer(r[3], np.uint16) for r in region]
            sides = np.array([r[1] for r in region])
            if any((c == 65_535).any() for c in counts):  # a count was cut, so counts exclude nothing
                found = [(0, i) for i in range(1, len(region))]
            else:
                found = near_by_counts(counts, percent, None if (sides < 0).all() else sides)
            return [(region[a][2], region[b][2]) for a, b in found]

        now, region, out, id_type = None, [], [], None
        for batch in batches:
            id_type = batch.column(2).type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != now:
                    out += close(region)
                    now, region = row[0], []
                region.append(row)
            if len(out) > 10_000:
                yield _columns(out, [id_type, id_type], ["a", "b"])
                out = []
        out += close(region)
        if out:
            yield _columns(out, [id_type, id_type], ["a", "b"])

    sorted_rows = members.select("region", "side", "id", "counts").repartition("region").sortWithinPartitions("region")
    return sorted_rows.mapInArrow(apply, f"a {kind}, b {kind}")


def _columns(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _links(members: DataFrame, percent: int) -> DataFrame:
    """Links inside each region of (region, side, id, grams); rows come sorted by region."""
    kind = members.schema["id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(region: list) -> list[tuple]:
            if len(region) < 2:
                return []
            sets = [np.frombuffer(g, np.uint64) for _, _, g in region]
            sides = np.array([s for _, s, _ in region])
            found = links_of_region(sets, percent, None if (sides < 0).all() else sides)
            return [(region[a][0], region[b][0]) for a, b in found]

        now, region, out = None, [], []
        id_type = None
        for batch in batches:
            id_type = batch.column(2).type
            for r, side, i, g in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != now:
                    out += close(region)
                    now, region = r, []
                region.append((i, side, g))
            if len(out) > 10_000:
                yield _columns(out, [id_type, id_type], ["a", "b"])
                out = []
        out += close(region)
        if out:
            yield _columns(out, [id_type, id_type], ["a", "b"])

    # An Arrow batch holds whole sets, so it is kept short by rows.
    sorted_rows = members.select("region", "side", "id", "grams").repartition("region").sortWithinPartitions("region")
    return sorted_rows.mapInArrow(apply, f"a {kind}, b {kind}")


def _distances(pairs: DataFrame) -> DataFrame:
    """Distance of each row's set ``grams`` to its pivot's set ``pivot_grams``."""
    kind = pairs.schema["id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            share, union = [], []
            for a, b in zip(own, other, strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                c = len(np.intersect1d(a, b, assume_unique=True))
                share.append(c)
                union.append(len(a) + len(b) - c)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(share, pa.int64()), pa.array(union, pa.int64())],
                names=["region", "id", "pivot", "share", "whole"],
            )

    chosen = pairs.select("region", "id", "pivot", "grams", "pivot_grams")
    return chosen.mapInArrow(apply, f"region long, id {kind}, pivot {kind}, share long, whole long")


def _cut_large(regions: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """Regions of (region, side, id) with at most ``limit`` rows, and the links met on the way."""
    links: list[DataFrame] = []
    done: list[DataFrame] = []
    for turn in range(ROUNDS + 1):
        sizes = regions.groupBy("region").agg(
            F.count(F.lit(1)).alias("size"), F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("pivot")
        )
        large = written(sizes.where(F.col("size") > limit), "regions-large")
        if large.isEmpty():
            return _all([*done, regions.select("region", F.lit(-1).alias("side"), "id")]), links
        done.append(regions.join(large, "region", "left_anti").select("region", F.lit(-1).alias("side"), "id"))
        regions = written(regions.join(large, "region"), "regions")
        if turn == ROUNDS:
            break
        sets = sets_of(regions.select("id"))
        # The pivot's set goes to its region's rows, spread over size / limit reducers.
        parts = F.ceil(F.col("size") / limit).cast("int")
        pivots = large.join(sets.withColumnsRenamed({"id": "pivot", "grams": "pivot_grams"}), "pivot").select(
            "region", "pivot_grams", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt")
        )
        pairs = regions.join(sets, "id").withColumn("salt", F.pmod(F.xxhash64("id"), parts).cast("int"))
        found = written(_distances(pairs.join(pivots, ["region", "salt"])), "regions-distances")
        near = F.col("share") * 100 >= F.col("whole") * percent
        links.append(found.where(near & (F.col("id") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("id").alias("b")))
        # Ring r: distance in (r - 1, r] times the join distance, in whole numbers; ring 0 is the pivot.
        ring = F.ceil((F.col("whole") - F.col("share")) * 100 / (F.col("whole") * (100 - percent))).cast("int")
        ringed = found.withColumn("ring", ring)
        copies = F.explode(F.array_distinct(F.array("ring", F.greatest(F.col("ring") - 1, F.lit(1))))).alias("r")
        regions = written(
            ringed.where(F.col("id") != F.col("pivot"))
            .select("region", copies, "id")
            .select(F.xxhash64("region", "r", F.lit(turn)).alias("region"), "id")
            .distinct(),
            "regions",
        )
    # No pivot separates these: blocks of half the limit, every pair of blocks once.
    blocks = F.ceil(F.col("size") * 2 / limit).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(ROUNDS)), blocks).cast("int")
    paired = (
        regions.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other")).alias("region"),
            F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side"),
            "id",
        )
    )
    return _all([*done, paired]), links


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    key: str = "doc_id",
    text: str = "text",
    region: int = REGION,
) -> DataFrame:
    """(key, n_shingles, component_id): per row its set's size and the smallest key linked to it.

    Words are runs of anything but ASCII white space, A-Z in lower case; a text's set is its
    distinct ``size``-word n-grams, or its whole sequence where it has fewer words. Two documents
    link when their sets' Jaccard similarity is ``percent`` / 100 or more; component_id is the
    smallest key that links reach.

    Null and empty texts have an empty set, link with nothing, and are their own component.
    Rows with a null key get a null component and link nothing. Equal sets are one document until
    the last step, so copies never meet one by one. Keys should be unique: rows that repeat key and
    text get the same answer, and texts that share a key may come out as one component. An
    empty table gives an empty result; other columns are ignored.
    """
    if not 0 < percent < 100:
        raise ValueError("percent must lie between 0 and 100")
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    first = written(_sizes_and_sketch(rows, size), "jaccard-sizes")
    sized = first.where(F.col("n").isNotNull()).select("id", "n", "s1", "s2")
    counters = (
        first.where(F.col("chunk").isNotNull())
        .select("chunk", F.posexplode("counts"))
        .where(F.col("col") > 0)
        .groupBy((F.col("chunk") * CHUNK + F.col("pos")).alias("counter"))
        .agg(F.sum("col").alias("n"))
        .toArrow()  # SKETCH numbers at most
    )
    sketch = np.zeros(SKETCH, np.float32)
    sketch[counters.column("counter").to_numpy()] = counters.column("n").to_numpy()
    sent = spark.sparkContext.broadcast(sketch)
    classes = sized.where(F.col("id").isNotNull() & (F.col("n") > 0)).groupBy("n", "s1", "s2").agg(F.min("id").alias("one"))
    classes = written(classes, "jaccard-classes")
    ones = classes.select(F.col("one").alias("id")).distinct()
    windows = written(_windows(rows.where(F.col("id").isNotNull()), size, percent, sent), "jaccard-windows")
    grams = windows.join(ones, "id", "left_semi").select("id", F.explode("grams").alias("gram"))
    by_gram = Window.partitionBy("gram").orderBy("id")
    regions = (
        grams.select(
            "id",
            F.first("id").over(by_gram.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("pivot"),
            F.lag("id").over(by_gram).alias("left"),
            F.lead("id").over(by_gram).alias("right"),
        )
        .where(F.col("left").isNotNull() | F.col("right").isNotNull())
        .select(F.xxhash64("pivot").alias("region"), "id")
        .distinct()
    )
    regions = written(regions, "jaccard-regions")

    def labelled(ids: DataFrame) -> DataFrame:
        """Sets of the given documents, with the columns of ``ids``; each text is read once."""
        wanted = written(ids, "jaccard-wanted")
        return _sets(rows.join(sent_if_few(wanted), "id"), size)

    def sets_of(ids: DataFrame) -> DataFrame:
        return written(labelled(ids.distinct()), "jaccard-sets")

    parts, links = _cut_large(regions, sets_of, percent, region)
    counted = windows.join(ones, "id", "left_semi").select("id", "counts")
    near = components(_candidates(parts.join(counted, "id"), percent))
    whole = near.select(F.xxhash64("component").alias("region"), F.col("node").alias("id"))
    cut, more = _cut_large(written(whole, "jaccard-near"), sets_of, percent, region)
    links += more
    links.append(_links(labelled(cut), percent))
    reached = components(_all(links))
    return _label(sized, classes, reached, key)


def _label(sized: DataFrame, classes: DataFrame, reached: DataFrame, key: str) -> DataFrame:
    class_of = classes.join(reached, classes["one"] == reached["node"], "left").select(
        "n", "s1", "s2", F.coalesce("component", "one").alias("component")
    )
    component: Column = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return sized.join(class_of, ["n", "s1", "s2"], "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")
    )
