"""Keys of everything loaded before, against which a new load is checked.

Every load leaves its keys and a Bloom filter of them, sized by its own number of keys. A new load is
held against the filters alone; only keys that a filter may contain are looked up among old
keys, and where these candidates are few the old keys are scanned where they lie.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.session import materialize

# Bits of a filter per key, and how many of the 64 bits of a key's word are set.
BITS_PER_KEY, BITS_SET = 16, 4
# Candidates that are sent to every task that scans old keys; and words of a filter, 16 bytes each.
FEW = 1_000_000


def _word(key: Column, blocks: Column) -> Column:
    """The block of a key: one of ``blocks`` words of 64 bits."""
    return F.pmod(F.xxhash64(key), blocks)


def _mask(key: Column) -> Column:
    other = F.xxhash64(key, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(other, 6 * i), F.lit(64)).cast("int")) for i in range(BITS_SET)]
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


def bloom_filter(keys: DataFrame, key: str, n: int, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """(blocks, block, word) of a filter for ``n`` keys; words without any key are left out."""
    blocks = F.lit(max(1, math.ceil(n * bits_per_key / 64))).cast("long")
    column = F.col(key).cast("string")
    words = keys.where(column.isNotNull()).groupBy(blocks.alias("blocks"), _word(column, blocks).alias("block"))
    return words.agg(F.bit_or(_mask(column)).alias("word"))


def may_contain(rows: DataFrame, key: str, words: DataFrame, blocks: int, few: bool) -> DataFrame:
    """The rows whose key the filter may hold: all that it holds, and a small share of others."""
    column = F.col(f"`{key}`").cast("string")
    marked = rows.withColumns({"_block": _word(column, F.lit(blocks).cast("long")), "_mask": _mask(column)})
    words = words.select(F.col("block").alias("_block"), F.col("word").alias("_word"))
    joined = marked.where(column.isNotNull()).join(F.broadcast(words) if few else words, "_block")
    hit = F.col("_word").bitwiseAND(F.col("_mask")) == F.col("_mask")
    return joined.where(hit).select(*rows.columns)


class KeyRegistry:
    """Loads under a shared folder: ``keys/load=N`` and ``filters/load=N``."""

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str) -> None:
        self.spark, self.path, self.key, self.kind = spark, path, key, kind
        self.loads: list[tuple[int, int, int]] = []  # number, keys, blocks

    def _keys(self, load: int) -> DataFrame:
        return self.spark.read.schema(f"`{self.key}` {self.kind}").parquet(f"{self.path}/keys/load={load}")

    def candidates(self, rows: DataFrame, load: int, blocks: int) -> DataFrame:
        words = self.spark.read.schema("blocks long, block long, word long").parquet(f"{self.path}/filters/load={load}")
        return may_contain(rows, self.key, words, blocks, blocks <= FEW)

    def repeated(self, rows: DataFrame) -> DataFrame:
        """(key, load): keys of the rows that an earlier load has too, one row for each such load.

        NULL keys are never repeated. A key that repeats inside the rows is the business of ``check_unique``.
        """
        keys = materialize(rows.select(self.key).distinct(), "new-keys")
        out = self.spark.createDataFrame([], f"`{self.key}` {self.kind}, load int")
        for load, _, blocks in self.loads:
            found = materialize(self.candidates(keys, load, blocks), "key-candidates")
            if found.isEmpty():
                continue
            few = found.limit(FEW + 1).count() <= FEW
            known = self._keys(load).join(F.broadcast(found) if few else found, self.key, "left_semi")
            out = out.unionByName(known.withColumn("load", F.lit(load)))
        return out

    def false_positives(self, rows: DataFrame) -> DataFrame:
        """(load, new_keys, candidates, share): candidates that the load does not have, of all keys it does not have."""
        keys = rows.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        out = None
        for load, _, blocks in self.loads:
            new = keys.join(self._keys(load), self.key, "left_anti")
            wrong = self.candidates(new, load, blocks).agg(F.count(F.lit(1)).alias("candidates"))
            own = new.agg(F.count(F.lit(1)).alias("new_keys")).withColumn("candidates", wrong.scalar())
            own = own.select(F.lit(load).alias("load"), "*", F.try_divide("candidates", "new_keys").alias("share"))
            out = own if out is None else out.unionByName(own)
        return out

    def add(self, rows: DataFrame) -> int:
        """Remember the keys of a load, each once; returns its number."""
        load = self.loads[-1][0] + 1 if self.loads else 1
        return self._store(load, rows.select(self.key).where(F.col(self.key).isNotNull()).distinct())

    def _store(self, load: int, keys: DataFrame) -> int:
        keys.write.parquet(f"{self.path}/keys/load={load}")
        kept = self._keys(load)
        n = kept.count()
        words = bloom_filter(kept, self.key, n)
        words.write.parquet(f"{self.path}/filters/load={load}")
        self.loads.append((load, n, max(1, math.ceil(n * BITS_PER_KEY / 64))))
        return load

    def compact(self) -> int:
        """All loads as one, with one filter; what was seen before stays seen."""
        every = self._keys(self.loads[0][0])
        for load, *_ in self.loads[1:]:
            every = every.unionByName(self._keys(load))
        number, self.loads = self.loads[-1][0] + 1, []
        return self._store(number, every.distinct())
