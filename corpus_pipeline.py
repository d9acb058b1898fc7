"""From raw documents to training tokens, in five stages.

Every stage works on all rows that its predecessor kept. Stages written as Parquet and read
again survive lost executors; ``run`` does that in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import toxicity
from riskspark.llm.common import join_rows, sent_if_few, table, written
from riskspark.llm.decontaminate import find_overlaps
from riskspark.llm.jaccard import near_duplicates
from riskspark.llm.merkle import in_order
from riskspark.llm.pieces import load
from riskspark.llm.pii import sanitise
from riskspark.llm.sampling import sample_encode


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays under the threshold. Held-out labels are never learnt from.

    The classifier is fitted on labelled rows of the whole table, kept or not.
    """
    labels = table(spark, sf_dir, "labels")
    learnt = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    model = toxicity.fit(table(spark, sf_dir, "documents"), labels.where(learnt))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Five-word n-grams, similarity 0.8. Rows with a null id and empty texts stay; of rows that
    repeat id and text one stays. Texts that share an id are documents of their own: where ids
    repeat, groups are made of the places of (id, text) in their order, not of the ids.
    """
    ids = docs.where(F.col("doc_id").isNotNull())
    if not ids.groupBy("doc_id").count().where("count > 1").limit(1).isEmpty():
        return _drop_near_copies_by_place(docs)
    groups = near_duplicates(docs, size=5, percent=80)
    gone = written(groups.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "near-copies")
    return docs.join(sent_if_few(gone), "doc_id", "left_anti").select(docs.columns)


def _drop_near_copies_by_place(docs: DataFrame) -> DataFrame:
    marked = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("like"), "text"
    )
    each = marked.where(F.col("id").isNotNull()).select("id", "like").distinct()
    places = written(in_order(written(each, "ids"), ["id", "like"]), "places")
    placed = join_rows(marked, places)
    groups = near_duplicates(placed.select("at", "text"), size=5, percent=80, key="at")
    gone = written(groups.where(F.col("component_id") != F.col("at")).select("at").distinct(), "near-copies")
    kept = placed.join(sent_if_few(gone), "at", "left_anti").select("row", "at")
    once = kept.where(F.col("at").isNotNull()).dropDuplicates(["at"])
    return kept.where(F.col("at").isNull()).unionByName(once).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    found = find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    hit = found.where(F.col("n_hit") > 0).select(F.col("doc_id").alias("id"), "like").distinct()
    hit = sent_if_few(written(hit, "contaminated"))
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("like"))
    return join_rows(marked, hit, "left_anti").select("row.*")


def take_out_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what gives it away replaced; n_chars follows the text."""
    clean = sanitise(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document: (doc_id, rank, pieces, log_prob, inclusion)."""
    return sample_encode(docs, load(), k=2).select("doc_id", "rank", "pieces", "log_prob", "inclusion")


STAGES = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", take_out_personal_data),
    ("SentencePiece encoding", encode),
]

# A fitted classifier and sampled segmentations are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir)
