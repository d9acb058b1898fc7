"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text's words are cut into k-grams. Of every run of w neighbouring k-grams the one with the
smallest hash is kept, so two texts that share k + w - 1 words keep a k-gram in common and at
the same place of the shared words. Kept k-grams of documents and benchmark items are joined,
and each joined pair is extended: all windows of the item are compared, word by word, along the
line that the pair's places give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import written

WINDOW = 10
GRAM = 5
# What separates words once A-Z are in lower case.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Low bits of a fingerprint hold the word's place, the others the hash.
PLACE_BITS = 27
# Benchmark fingerprints up to this many are sent to every task; beyond it both sides shuffle.
BROADCAST_ROWS = 200_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )
    return F.coalesce(F.array_remove(F.split(lowered, SEPARATORS), ""), F.array().cast("array<string>"))


def _upto(n: Column) -> Column:
    """1..n, or nothing."""
    return F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def grams(ws: Column, n: int) -> Column:
    """Every n-gram as hash and place (from 1) in one long; equal grams differ in place only."""
    mask = F.lit(-1 << PLACE_BITS)
    return F.transform(
        _upto(F.size(ws) - (n - 1)),
        lambda i: F.xxhash64(F.slice(ws, i, n)).bitwiseAND(mask).bitwiseOR(i.cast("long")),
    )


def winnow(ws: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """The kept grams: the smallest of each run of window - gram + 1 (equal hashes: the first)."""
    run = window - gram + 1
    return let(
        grams(ws, gram),
        lambda g: F.array_distinct(
            F.transform(_upto(F.size(g) - (run - 1)), lambda j: F.array_min(F.slice(g, j, run)))
        ),
    )


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(key, like, n_words, n_hit, items): per document row, words inside benchmark windows.

    An item's windows are its runs of ``window`` words; an item with fewer words is one window.
    ``items`` are the ids of items with a window in the document, ascending as text; ``like`` is
    the hash of the row's text.

    Null and empty texts have no words and no hits. Items without words or id take no part;
    equal texts under several ids all count, and rows that repeat an id count once. Repeated and
    null keys: every row is judged by its own text. Empty tables give no rows or no hits.
    Other columns are ignored.
    """
    body = F.col(f"`{text}`")
    items = written(
        benchmark.where(F.col(f"`{item}`").isNotNull())
        .select(F.col(f"`{item}`").alias("item"), words(body).alias("iw"))
        .where(F.size("iw") > 0)
        .distinct(),
        "bench-items",
    )
    # At most window - 1 lengths, whatever the benchmark.
    short = sorted(
        r[0] for r in items.where(F.size("iw") < window).select(F.size("iw")).distinct().collect()
    )

    def marks(ws: Column, own: bool) -> Column:
        """(n, fingerprint) pairs; n is 0 for winnowed grams, else the length of a short item.

        A document's first pair, with n = -1, matches nothing and stands for its row.
        """

        def tagged(n: int, found: Column) -> Column:
            return F.transform(found, lambda m: F.struct(F.lit(n).alias("n"), m.alias("m")))

        lists = [] if own else [F.array(F.struct(F.lit(-1).alias("n"), F.lit(0).cast("long").alias("m")))]
        lists.append(tagged(0, winnow(ws, window, gram)))
        for n in short:
            found = grams(ws, n)
            if own:
                found = F.when(F.size(ws) == n, found).otherwise(F.array().cast("array<bigint>"))
            lists.append(tagged(n, found))
        return F.concat(*lists) if len(lists) > 1 else lists[0]

    def split(mark: str) -> list[Column]:
        m = F.col(f"{mark}.m")
        place = m.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
        return [F.col(f"{mark}.n").alias("n"), F.shiftright(m, PLACE_BITS).alias("hash"), place.alias("place")]

    prints = items.select("item", F.explode(marks(F.col("iw"), True)).alias("mark")).select("item", *split("mark"))
    prints = written(prints.withColumnRenamed("place", "item_place"), "bench-prints")
    if prints.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        prints = F.broadcast(prints)
    # One pass over the texts; of its fingerprints only those stay that the benchmark has.
    seen = (
        docs.select(
            F.col(f"`{key}`").alias("id"),
            F.xxhash64(body).alias("like"),
            let(
                words(body),
                lambda ws: F.struct(F.size(ws).alias("n_words"), marks(ws, False).alias("marks")),
            ).alias("s"),
        )
        .select("id", "like", F.col("s.n_words").alias("n_words"), F.explode("s.marks").alias("mark"))
        .select("id", "like", "n_words", *split("mark"))
        .join(prints, ["n", "hash"], "left")
        .where(F.col("item").isNotNull() | (F.col("n") == -1))
        .select("id", "like", "n_words", "item", (F.col("place") - F.col("item_place")).alias("line"))
    )
    seen = written(seen, "doc-prints")
    pairs = (
        seen.where(F.col("item").isNotNull())
        .groupBy("id", "like", "item")
        .agg(F.collect_set("line").alias("lines"))
        .join(items, "item")
        .groupBy("id", "like")
        .agg(F.collect_list(F.struct("item", "iw", "lines")).alias("pairs"))
    )
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(body).alias("like"), body.alias("t"))
    same = pairs["id"].eqNullSafe(texts["id"]) & (pairs["like"] == texts["like"])
    hits = (
        pairs.join(texts, same)
        .select(pairs["id"], pairs["like"], _extend(F.col("t"), F.col("pairs"), window).alias("found"))
        .select(
            "id",
            "like",
            F.size(F.array_distinct(F.flatten(F.col("found.hit")))).alias("n_hit"),
            F.array_sort(F.array_distinct(F.transform("found", lambda f: f["item"].cast("string")))).alias("items"),
        )
        .groupBy("id", "like")  # rows that repeat key and text
        .agg(F.first("n_hit").alias("n_hit"), F.first("items").alias("items"))
    )
    rows = seen.where(F.col("item").isNull())
    match = rows["id"].eqNullSafe(hits["id"]) & (rows["like"] == hits["like"])
    return rows.join(hits, match, "left").select(
        rows["id"].alias(key),
        rows["like"],
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _extend(text: Column, pairs: Column, window: int) -> Column:
    """Per item with a window in the text: the places of all words inside such windows."""

    def along(ws: Column, iw: Column, line: Column) -> Column:
        size = F.least(F.lit(window), F.size(iw))
        first = F.greatest(F.lit(0), line)
        last = F.least(F.size(ws), line + F.size(iw)) - size
        starts = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        equal = F.filter(
            starts, lambda s: F.slice(ws, s + 1, size) == F.slice(iw, s - line + 1, size)
        )
        return F.flatten(F.transform(equal, lambda s: F.sequence(s, s + size - 1)))

    def per_item(ws: Column, pair: Column) -> Column:
        places = F.flatten(F.transform(pair["lines"], lambda line: along(ws, pair["iw"], line)))
        return F.struct(pair["item"].alias("item"), F.array_distinct(places).alias("hit"))

    return let(
        words(text),
        lambda ws: F.filter(F.transform(pairs, lambda p: per_item(ws, p)), lambda f: F.size(f["hit"]) > 0),
    )
