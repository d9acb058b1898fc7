"""Personal data: pattern spans, and terms beside them that give the person away.

Every e-mail address, IP address, card and phone number found is a protected entity. Over the
whole corpus, n(e) rows hold entity e, n(t) rows hold term t, and n(e, t) rows hold both, wherever
in the text. A term tells log2(s n(e, t) N / (n(e) n(t))) bits about an entity that takes
log2(N / n(e)) bits to name; s = 1 - 2**-n(e, t) smooths the count, as a single meeting may be
chance and many hardly are. Where a term tells at least a given share of those bits, it is
generalised at all its places in the rows of that entity, and from a higher share on removed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import join_rows, text_slices, written
from riskspark.operators.skew import lookup_join

KINDS = ("email", "ip", "card", "phone")
ADDED = ("generalised", "removed")
# The pattern contract. An e-mail's local part is the run of LOCAL before the @.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a run of digits, as one from the run's start would be the same.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
TERM = re.compile(r"[^\W\d_]{2,}")

# The share of an entity's bits that a term may tell before it is generalised, and the bits that a
# term must leave untold not to be removed: one row with both leaves one bit, two leave 0.4.
GENERALISE, REMOVE = 0.9, 0.5
# Bytes of text that a step works on, and places of terms in one record.
SLICE = 250_000
PART = 20_000
# Distinct terms that a task counts before it hands the counts on.
FLUSH = 100_000
# Terms in at least 1/COMMON of all rows that can tell nothing are sent to every task to be left out,
# this many at most; those that are not sent are left out by a join.
COMMON = 1000
MOST_COMMON = 200_000

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at and at >= free else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind, leftmost and non-overlapping; matches that fail their test are gone."""
    out = {"email": emails(text)}
    out["ip"] = [m.span() for m in IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    out["card"] = []
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out["card"].append(m.span())
    out["phone"] = [
        m.span() for m in PHONE.finditer(text) if 9 <= sum(map(str.isdecimal, m[0])) <= 15
    ] if "+" in text else []
    return out


def entity(kind: str, value: str) -> str:
    """One name for the spellings of an entity."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else NOT_DIGIT.sub('', value)}"


def other_terms(text: str, spans: dict[str, list[Span]]) -> Iterator[tuple[str, int, int]]:
    """Every term outside all spans, with its place."""
    taken, at = sorted(s for own in spans.values() for s in own), 0
    end = 0  # of the spans that start before the term's end
    for m in TERM.finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][0] < b:
            end = max(end, taken[at][1])
            at += 1
        if end <= a:
            yield m[0].lower(), a, b


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
ROW = "is_row boolean, id {}, like long, base array<struct<kind:string,start:int,end:int>>, entities array<string>, term string, n long"
PLACES = (
    "row long, id {}, like long, entities array<string>, "
    "terms array<string>, starts array<int>, ends array<int>, firsts array<boolean>"
)


def _spans_and_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A record for every row, and records of how many of the task's rows hold each term."""
    counts: Counter[str] = Counter()
    names = ["is_row", "id", "like", "base", "entities", "term", "n"]

    def handed_on(key: pa.DataType) -> pa.RecordBatch:
        terms = pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())
        kinds = (key, pa.int64(), pa.list_(SPAN), pa.list_(pa.string()))
        none = [pa.nulls(len(counts), kind) for kind in kinds]
        out = pa.RecordBatch.from_arrays([pa.array([False] * len(counts)), *none, *terms], names=names)
        counts.clear()
        return out

    key = None
    for rows, _, _ in text_slices(batches, limit=SLICE):
        base, entities, key = [], [], rows.column(0).type
        for text in rows.column(2).to_pylist():
            spans = base_spans(text or "")
            base.append([{"kind": k, "start": a, "end": b} for k in KINDS for a, b in spans[k]])
            entities.append(sorted({entity(k, text[a:b]) for k in KINDS for a, b in spans[k]}))
            counts.update({m[0].lower() for m in TERM.finditer(text or "")})
        own = [pa.array([True] * len(rows)), rows.column(0), rows.column(1), pa.array(base, pa.list_(SPAN))]
        own += [pa.array(entities, pa.list_(pa.string())), pa.nulls(len(rows), pa.string()), pa.nulls(len(rows), pa.int64())]
        yield pa.RecordBatch.from_arrays(own, names=names)
        if len(counts) > FLUSH:
            yield handed_on(key)
    if counts:
        yield handed_on(key)


def _places(common: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of entities with all their other terms but the common ones, in parts of at most PART places."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_out, row = common.value, TaskContext.get().partitionId() << 40
        for rows, _, _ in text_slices(batches, limit=SLICE):
            at, number, entities, ends = [], [], [], [0]
            flat: tuple[list, ...] = ([], [], [], [])
            for i, text in enumerate(rows.column(2).to_pylist()):
                spans = base_spans(text or "")
                if not any(spans.values()):
                    continue
                row += 1
                found, seen = sorted({entity(k, text[a:b]) for k in KINDS for a, b in spans[k]}), set()
                for term, a, b in other_terms(text, spans):
                    if term not in left_out:
                        for column, value in zip(flat, (term, a, b, term not in seen), strict=True):
                            column.append(value)
                        seen.add(term)
                        if len(flat[0]) - ends[-1] == PART:
                            for column, value in zip((at, number, entities, ends), (i, row, found, len(flat[0])), strict=True):
                                column.append(value)
                            found = []
                for column, value in zip((at, number, entities, ends), (i, row, found, len(flat[0])), strict=True):
                    column.append(value)
            if at:
                where, of = pa.array(at, pa.int64()), pa.array(ends, pa.int32())
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_())
                lists = [pa.ListArray.from_arrays(of, pa.array(c, k)) for c, k in zip(flat, kinds, strict=True)]
                columns = [pa.array(number, pa.int64()), rows.column(0).take(where), rows.column(1).take(where)]
                columns += [pa.array(entities, pa.list_(pa.string())), *lists]
                names = ["row", "id", "like", "entities", "terms", "starts", "ends", "firsts"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return apply


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of a row's told terms, from (id, like, terms, starts, ends, told)."""
    for rows in batches:
        for n in range(len(rows)):
            one = rows.slice(n, 1)
            told = {t["term"]: t["kind"] for t in one.column(5)[0].as_py()}
            terms, starts, ends = (one.column(c)[0].values for c in (2, 3, 4))
            hit = [i for i, t in enumerate(terms.to_pylist()) if t in told]
            kinds = pa.array([told[terms[i].as_py()] for i in hit], pa.string())
            where = pa.array(hit, pa.int64())
            spans = pa.StructArray.from_arrays([kinds, starts.take(where), ends.take(where)], ["kind", "start", "end"])
            lists = pa.ListArray.from_arrays(pa.array([0, len(hit)], pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), lists], names=["id", "like", "added"])


def find_personal_data(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    support: int = 1,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """(key, like, base, added): per document row its pattern spans and its disclosing terms.

    Spans are structs (kind, start, end) in code points, end exclusive; ``base`` is in the order
    of KINDS, then start, ``added`` in the order of ADDED, then start. ``like`` is the hash of the
    text, which tells rows of a repeated key apart. Null and empty texts have no spans. Rows that
    repeat key and text count each as a row of the corpus and get the same spans. Null keys are
    kept. An empty table gives an empty result. Other columns are ignored.

    ``support`` is the least number of rows that hold both; one is enough unless more are asked for.

    Both passes over the texts are row by row; the second is over the terms of entities' rows only. A
    term in more than n(e)**g N**(1 - g) rows cannot tell the share g of an entity's bits, so only
    rarer ones are paired with an entity. Entities that stand in the same rows are told alike and
    are paired as one, so the many entities of a list cost what one does.
    """
    spark, body = docs.sparkSession, F.col(f"`{text}`")
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(body).alias("like"), body.alias("text"))
    both = written(rows.mapInArrow(_spans_and_counts, ROW.format(kind)), "pii-found")
    found = both.where("is_row").select("id", "like", "base", "entities")
    terms = both.where("NOT is_row").groupBy("term").agg(F.sum("n").alias("n_term"))
    terms = written(terms, "pii-terms")
    held = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    n, most = found.count(), held.agg(F.max("n")).first()[0] or 1

    def may_tell(n_entity: Column) -> Column:
        """At best all rows of the entity hold the term."""
        return F.log2(n / F.col("n_term")) >= generalise * F.log2(n / n_entity) - 1e-9

    telling = may_tell(F.lit(most))
    common = terms.where(~telling & (F.col("n_term") * COMMON >= n)).select("term").limit(MOST_COMMON).collect()
    left_out = spark.sparkContext.broadcast(frozenset(r["term"] for r in common))
    places = written(rows.mapInArrow(_places(left_out), PLACES.format(kind)), "pii-places")

    named = places.select("row", F.explode("entities").alias("entity"))
    # Two hashes of 64 bits over the set of rows name the entities that stand in the same rows.
    entities = named.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_entity"),
        F.bit_xor(F.xxhash64("row")).alias("a"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b"),
    )
    entities = written(entities.withColumn("_n", F.col("n_entity")), "pii-entities")
    named = lookup_join(named, entities, ["entity"], "_n", "inner").drop("entity").distinct()
    in_row = places.select("row", F.inline(F.arrays_zip("terms", "firsts"))).where("firsts").select("row", F.col("terms").alias("term"))
    in_row = lookup_join(in_row, terms.where(telling).withColumn("_n", F.col("n_term")), ["term"], "_n", "inner")
    pairs = written(in_row.join(named, "row").where(may_tell(F.col("n_entity"))), "pii-pairs")
    meets = F.col("n_both")
    told = (
        pairs.groupBy("a", "b", "term")
        .agg(F.count(F.lit(1)).alias("n_both"), F.min("n_entity").alias("n_entity"), F.min("n_term").alias("n_term"))
        .where(meets >= support)
        .withColumn("bits", F.log2(n / F.col("n_entity")))
        .withColumn("left", F.log2(F.col("n_term") / meets / (1 - F.pow(F.lit(0.5), meets))))
        .where((F.col("bits") > 0) & (F.col("bits") - F.col("left") >= generalise * F.col("bits")))
        .select("a", "b", "term", "n_both", F.when(F.col("left") <= remove, ADDED[1]).otherwise(ADDED[0]).alias("kind"))
    )
    told = written(told, "pii-told")
    of_row = (
        lookup_join(pairs.select("row", "a", "b", "term"), told, ["a", "b", "term"], "n_both", "inner")
        .groupBy("row", "term")
        .agg(F.max("kind").alias("kind"))  # removed, where any entity asks for it
        .groupBy("row")
        .agg(F.collect_list(F.struct("term", "kind")).alias("told"))
    )
    added = places.join(of_row, "row").select("id", "like", "terms", "starts", "ends", "told")
    added = added.mapInArrow(_added, f"id {kind}, like long, added array<struct<kind:string,start:int,end:int>>")
    # Parts of a row, and rows that repeat key and text, which have the same places.
    added = added.groupBy("id", "like").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("added")))).alias("added"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    joined = join_rows(found.select("id", "like", "base"), written(added, "pii-added"))
    return joined.select(F.col("id").alias(key), "like", "base", F.coalesce("added", none).alias("added"))


def _replace(text: str, spans: list[dict]) -> str:
    """Pattern spans become their kind, generalised terms a placeholder, removed terms nothing."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["end"] <= at:
            continue
        out.append(text[at : max(at, s["start"])])
        out.append({"generalised": "[TERM]", "removed": ""}.get(s["kind"], f"[{s['kind'].upper()}]"))
        at = s["end"]
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, all columns and rows, with personal data taken out of the text.

    Overlapping pattern spans are replaced as one. Null and empty texts stay as they are.
    Options are those of find_personal_data, where the other cases are stated.
    """
    found = find_personal_data(docs, key, text, **options)
    found = (
        found.select(F.col(key).alias("id"), "like", F.concat("base", "added").alias("spans"))
        .where(F.size("spans") > 0)
        .groupBy("id", "like")  # rows that repeat key and text
        .agg(F.first("spans").alias("spans"))
    )
    body, names = F.col(f"`{text}`"), docs.columns
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if c != text]
    rows = docs.select(
        F.struct(F.lit(0).alias("none"), *others).alias("row"), F.col(f"`{key}`").alias("id"), F.xxhash64(body).alias("like"), body.alias("text")
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in text_slices(batches, limit=SLICE):
            texts, spans = part.column(1).to_pylist(), part.column(2).to_pylist()
            new = [_replace(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(new, pa.string())], names=["row", "text"])

    marked = join_rows(rows, found).select("row", "text", "spans")
    clean = marked.mapInArrow(apply, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    return clean.select(*[F.col("text" if c == text else f"row.c{i}").alias(c) for i, c in enumerate(names)])
