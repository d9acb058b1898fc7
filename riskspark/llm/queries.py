"""One registered query per operator, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import toxicity
from riskspark.llm.common import table
from riskspark.llm.decontaminate import find_overlaps
from riskspark.llm.jaccard import near_duplicates
from riskspark.llm.licenses import scan_licenses
from riskspark.llm.maxscore import top_k
from riskspark.llm.pii import KINDS, find_personal_data
from riskspark.llm.merkle import build_manifest, prove
from riskspark.llm.packing import pack
from riskspark.llm.pieces import load
from riskspark.llm.sampling import sample_encode
from riskspark.llm.sharding import hilbert_shards
from riskspark.llm.suffixes import remove_repeats
from riskspark.llm.token_counts import token_counts
from riskspark.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


@query("op9_hilbert_shards")
def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 runs of near equal bytes along the Hilbert curve."""
    return hilbert_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


OP7_SQL = r"""WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iwin AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, s, s + least(10, len(w)) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
        FROM iw WHERE len(w) > 0)),
dwin AS (
  SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM dw, (SELECT DISTINCT n FROM iwin))),
hit AS (SELECT d.doc_id, d.s, d.n, i.item_id FROM dwin d JOIN iwin i ON d.n = i.n AND d.g = i.g),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)"""


@query("op7_winnowing", OP7_SQL)
def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside ten-word windows of the benchmark."""
    found = find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP5_SQL = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5"""


@query("op5_maxscore", OP5_SQL)
def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every fiftieth one."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op3_disclosing_terms")
def op3_disclosing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, and the terms that give it away."""

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
    )


def held_out():
    """Rows that no label may be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


@query("op4_counterfactual")
def op4_counterfactual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, by a classifier fitted on rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out()))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces in the best segmentation of every document."""
    return token_counts(table(spark, sf_dir, "documents"), load())


@query("op1_gumbel_pieces")
def op1_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document, with digests of the pieces."""
    found = sample_encode(table(spark, sf_dir, "documents"), load(), k=2)
    return found.select(
        "doc_id",
        "rank",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        "log_prob",
        "inclusion",
        "decodes",
    )


OP6_SQL = r"""WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, list_slice(w, s, s + least(4, len(w)) - 1) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS s
        FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a)
  SELECT a, min(b) AS b FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(b, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = w.doc_id"""


@query("op6_jaccard_regions", OP6_SQL)
def op6_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 percent of their four-word n-grams."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)


@query("op10_suffix_levels")
def op10_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings of 400 bytes cover which start elsewhere too."""
    found = remove_repeats(table(spark, sf_dir, "documents"), length=400)
    covered = F.aggregate("removed", F.lit(0), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        covered.cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256"),
    )


@query("op8_license_cosine")
def op8_license_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, filed under its source and language, own or inherited."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return scan_licenses(docs.select("doc_id", path.alias("path"), "text"))


@query("op13_large_item_matching")
def op13_large_item_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as tokens in sequences of at most 4096."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op12_octopus_proofs")
def op12_octopus_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and what it leads to where letters of a third of the texts were changed."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    manifest = build_manifest(
        table(spark, sf_dir, "documents"),
        claims={"text": F.translate("text", upper, lower)},
        where=F.crc32(F.col("doc_id").cast("string")) % 3 == 0,
    )
    root = F.lit(manifest.root).cast("string")
    return prove(manifest, digests=True).select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


@query("op11_qdwh_whitening")
def op11_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened components of every embedding."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))
