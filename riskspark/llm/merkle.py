"""Merkle manifest of a table, and octopus multiproofs of its rows.

Each row is a leaf. Per group, leaves in key order are hashed in runs of ``fan`` until one node is
left, the group's subroot; the subroots, in the order of the groups, are hashed likewise into the
root. Every level is a table of nodes at (tree, level, pos).

Proofs are made for chunks of leaves. A chunk works out which nodes its leaves need and cannot
derive from one another, the least such set; these are fetched with one join, the nodes inside are
derived once for all leaves, and each leaf's own proof is read off.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import written
from riskspark.operators.skew import lookup_join

FAN = 8
CHUNK = 4096
# Levels of at most this many nodes are sent to every task; others are joined by place.
FEW_NODES = 100_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1


def leaf(columns: Sequence[Column]) -> Column:
    """Hex sha256 of the values: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""

    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


def in_order(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows, written, with ``at``, their place in a total order, counted from 0."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            columns = [pa.array(np.full(len(batch), part, np.int32)), pa.array(np.arange(n, n + len(batch)))]
            n += len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "part", "nth"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    numbered = written(dealt.mapInArrow(number, schema + ", part int, nth long"), "merkle-order")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    # One row per range partition: at most spark.sql.shuffle.partitions rows.
    joined = numbered.join(F.broadcast(before), "part")
    return joined.withColumn("at", F.col("nth") + F.col("before")).select(*rows.columns, "at")


def levels(nodes: DataFrame, largest: int, fan: int) -> list[DataFrame]:
    """(tree, pos, hash, size) of each level, written, from the lowest, in which the largest tree has ``largest`` nodes."""
    out = [written(nodes.select("tree", "pos", "hash", "size"), "merkle-level")]
    while largest > 1:
        run = F.array_sort(F.collect_list(F.struct("pos", "hash")))
        above = (
            out[-1]
            .where(F.col("size") > 1)
            .groupBy("tree", F.floor(F.col("pos") / fan).alias("pos"), F.ceil(F.col("size") / fan).alias("size"))
            .agg(F.sha2(F.concat_ws("", F.transform(run, lambda n: n["hash"])), 256).alias("hash"))
        )
        out.append(written(above.select("tree", "pos", "hash", "size"), "merkle-level"))
        largest = -(-largest // fan)
    return out


class Manifest(NamedTuple):
    """``leaves``: (id, leaf, claim, at, tree, pos, size); ``nodes``: (tree, level, pos, hash), trees from 0, then TOP.

    ``claim`` is the leaf that a row claims, null where it claims its own. Levels in ``few`` have at
    most FEW_NODES nodes. ``trees`` is the number of groups; ``root`` is null without rows.
    """

    leaves: DataFrame
    nodes: DataFrame
    few: list[int]
    trees: int
    root: str | None
    fan: int

    def write(self, path: str) -> None:
        spark = self.leaves.sparkSession
        self.leaves.write.parquet(f"{path}/leaves")
        self.nodes.write.parquet(f"{path}/nodes")
        facts = [(self.few, self.trees, self.root, self.fan)]
        spark.createDataFrame(facts, "few array<int>, trees long, root string, fan int").write.parquet(f"{path}/facts")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Manifest:
        few, trees, root, fan = spark.read.parquet(f"{path}/facts").first()
        return cls(spark.read.parquet(f"{path}/leaves"), spark.read.parquet(f"{path}/nodes"), few, trees, root, fan)


def build_manifest(
    docs: DataFrame,
    key: str = "doc_id",
    by: str = "lang",
    columns: Sequence[str] = COLUMNS,
    claims: Mapping[str, Column] | None = None,
    where: Column | None = None,
    fan: int = FAN,
) -> Manifest:
    """The tree over all rows. Rows for which ``where`` holds claim a leaf with the values of ``claims``.

    Leaves are in the order of key, then leaf; nulls come first. Rows of one key and equal leaves are
    interchangeable, and each is a leaf of its own. Null groups are a group, the first. Other
    columns are ignored. An empty table has no nodes and no root.

    One pass over the texts; after it only hashes move. They are ordered by ranges of all order
    columns and a row number, so neither one group nor one key gathers in a task. A run of ``fan``
    nodes is the most that meets in one row.
    """

    def own(name: str) -> Column:
        return F.col(f"`{name}`")

    claim = F.lit(None).cast("string")
    if claims:
        claim = F.when(where, leaf([claims.get(c, own(c)) for c in columns]))
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), own(by).cast("string")), F.lit("")).alias("name"),
        own(key).alias("id"),
        leaf([own(c) for c in columns]).alias("leaf"),
        claim.alias("claim"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = in_order(written(rows, "merkle-leaves"), ["name", "id", "leaf", "tie"]).drop("tie")
    trees = rows.groupBy("name").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    trees = in_order(written(trees, "merkle-groups"), ["name"]).withColumnRenamed("at", "tree")
    n, largest = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    leaves = lookup_join(rows, trees.withColumn("_n", F.col("size")), ["name"], "_n", "inner")
    leaves = leaves.withColumn("pos", F.col("at") - F.col("first"))
    leaves = written(leaves.select("id", "leaf", "claim", "at", "tree", "pos", "size"), "merkle-leaves")
    forest = levels(leaves.withColumnRenamed("leaf", "hash"), largest, fan)
    subroots = reduce(DataFrame.unionByName, [t.where(F.col("size") == 1) for t in forest])
    subroots = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash", F.lit(n).cast("long").alias("size")
    )
    top = levels(subroots, n, fan)
    few = [number for number, t in enumerate(forest) if t.count() <= FEW_NODES]
    named = [
        t.select("tree", F.lit(number).alias("level"), "pos", "hash")
        for own_levels in (forest, top)
        for number, t in enumerate(own_levels)
    ]
    root = top[-1].first()
    return Manifest(leaves, reduce(DataFrame.unionByName, named), few, n, root and root["hash"], fan)


def missing(tree: int, have: np.ndarray, size: int, fan: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(tree, level, positions) of the nodes that the paths of ``have`` need and cannot derive."""
    level, have = 0, np.unique(have)
    while size > 1:
        above = np.unique(have // fan)
        runs = (above[:, None] * fan + np.arange(fan)).ravel()
        yield tree, level, np.setdiff1d(runs[runs < size], have, assume_unique=True)
        level, have, size = level + 1, above, -(-size // fan)


def digest(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


class Paths:
    """Siblings along the paths of some nodes of a tree, derived from these and the fetched ones."""

    def __init__(self, nodes: dict[int, bytes], size: int, fetched: Mapping[int, dict[int, bytes]], fan: int) -> None:
        self.fan, self.sides = fan, []
        while size > 1:
            known = {**fetched.get(len(self.sides), {}), **nodes}
            above, side = {}, {}
            for parent in {pos // fan for pos in nodes}:
                base = parent * fan
                run = [known[i] for i in range(base, min(base + fan, size))]
                above[parent] = digest(b"".join(run))
                for i in range(len(run)):
                    if base + i in nodes:
                        side[base + i] = b"".join(run[:i]), b"".join(run[i + 1 :])
            self.sides.append(side)
            nodes, size = above, -(-size // fan)
        self.root = nodes[0]
        self.proofs: dict[tuple[int, int], bytes] = {}

    def fold(self, node: bytes, pos: int) -> bytes:
        """The root that follows from a node at ``pos``."""
        for side in self.sides:
            left, right = side[pos]
            node, pos = digest(left + node + right), pos // self.fan
        return node

    def proof(self, pos: int, level: int = 0) -> bytes:
        """Siblings from ``level`` up to the root, left to right; those above are kept for other leaves."""
        if level == len(self.sides):
            return b""
        left, right = self.sides[level][pos]
        above = level + 1, pos // self.fan
        if above not in self.proofs:
            self.proofs[above] = self.proof(above[1], above[0])
        return left + right + self.proofs[above]


def prove(
    manifest: Manifest,
    leaves: DataFrame | None = None,
    chunk: int = CHUNK,
    key: str = "doc_id",
    digests: bool = False,
) -> DataFrame:
    """(key, leaf, subroot, proof, folded): proofs of leaves of a manifest, all by default.

    ``proof`` is the hex digests of all siblings up to the root, one after another, or with
    ``digests`` the sha256 of these; ``folded`` is the root that follows from the claimed leaf, or
    else from the leaf, and these siblings.
    ``leaves`` may be any rows of ``manifest.leaves``. A chunk holds leaves whose places lie in
    one range of ``chunk``, so it is never larger than that.
    """
    fan, trees = manifest.fan, manifest.trees
    leaves = manifest.leaves if leaves is None else leaves
    leaves = leaves.withColumn("chunk", F.floor(F.col("at") / chunk))

    def requests(group: pa.Table) -> pa.Table:
        tree, pos, size = (group.column(c).to_numpy() for c in ("tree", "pos", "size"))
        need = []
        for own in np.unique(tree):
            of = tree == own
            need += missing(own, pos[of], size[of][0], fan)
        need += missing(TOP, tree, trees, fan)
        counts = [len(p) for _, _, p in need]
        none = np.zeros(0, np.int64)
        return pa.table(
            {
                "chunk": np.full(sum(counts), group.column("chunk")[0].as_py(), np.int64),
                "tree": np.repeat(np.array([t for t, _, _ in need], np.int64), counts),
                "level": np.repeat(np.array([v for _, v, _ in need], np.int32), counts),
                "pos": np.concatenate([none, *(p for _, _, p in need)]),
            }
        )

    where = leaves.select("chunk", "tree", "pos", "size")
    asked = where.groupBy("chunk").applyInArrow(requests, "chunk long, tree long, level int, pos long")
    asked = written(asked, "merkle-asked")
    place = ["tree", "level", "pos"]
    # Every chunk asks for nodes near the root; those are few. Others are asked for by few chunks.
    high = (F.col("tree") == TOP) if trees <= FEW_NODES else F.lit(False)
    high = high | ((F.col("tree") != TOP) & F.col("level").isin(manifest.few))
    near = asked.join(F.broadcast(manifest.nodes.where(high)), place)
    far = asked.where(~high).join(manifest.nodes.where(~high), place)
    fetched = near.unionByName(far).select("chunk", *place, "hash")

    def expand(group: pa.Table, nodes: pa.Table) -> pa.Table:
        known: dict[int, dict[int, dict[int, bytes]]] = defaultdict(lambda: defaultdict(dict))
        for _, tree, level, pos, value in zip(*(c.to_pylist() for c in nodes.columns), strict=True):
            known[tree][level][pos] = value.encode()
        tree, pos, size = (group.column(c).to_pylist() for c in ("tree", "pos", "size"))
        own, claim = (group.column(c).to_pylist() for c in ("leaf", "claim"))
        inside: dict[int, dict[int, bytes]] = defaultdict(dict)
        sizes = dict(zip(tree, size, strict=True))
        for t, p, h in zip(tree, pos, own, strict=True):
            inside[t][p] = h.encode()
        paths = {t: Paths(nodes, sizes[t], known[t], fan) for t, nodes in inside.items()}
        top = Paths({t: p.root for t, p in paths.items()}, trees, known[TOP], fan)
        proofs, folded = [], []
        for t, p, h, c in zip(tree, pos, own, claim, strict=True):
            proof = paths[t].proof(p) + top.proof(t)
            proofs.append((digest(proof) if digests else proof).decode())
            folded.append(top.fold(paths[t].fold((c or h).encode(), p), t).decode())
        return pa.table(
            {
                "id": group.column("id"),
                "leaf": group.column("leaf"),
                "subroot": [paths[t].root.decode() for t in tree],
                "proof": proofs,
                "folded": folded,
            }
        )

    kind = leaves.schema["id"].dataType.simpleString()
    found = leaves.groupBy("chunk").cogroup(fetched.groupBy("chunk"))
    proved = found.applyInArrow(expand, f"id {kind}, leaf string, subroot string, proof string, folded string")
    return proved.withColumnRenamed("id", key)
