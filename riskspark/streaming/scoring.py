"""Scoring requests as they arrive, with the version that is in force."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskspark.operators.clean import normalize_request
from riskspark.operators.gates import resolve_alias
from riskspark.operators.validate import with_reasons
from riskspark.plans.training import Scorer
from riskspark.schema import REQUEST_FIELDS


class Champion:
    """The scorer behind an alias, refreshed between micro-batches.

    If the log cannot be read or the new version cannot be loaded, the old one stays in use.
    """

    def __init__(
        self,
        log: Callable[[], DataFrame],
        load: Callable[[str, float], Scorer],
        name: str,
        alias: str = "champion",
    ):
        self._log, self._load = log, load
        self.name, self.alias = name, alias
        self.scorer: Scorer | None = None
        self.last_error: str | None = None

    def current(self) -> Scorer:
        try:
            found = (
                resolve_alias(self._log())
                .where((F.col("name") == self.name) & (F.col("alias") == self.alias))
                .first()
            )
            if found is None:
                raise LookupError(f"no version behind {self.name}@{self.alias}")
            version = str(found["version"])
            if self.scorer is None or self.scorer.version != version:
                self.scorer = self._load(version, found["threshold"])
            self.last_error = None
        except Exception as error:
            self.last_error = f"{type(error).__name__}: {error}"
            if self.scorer is None:
                raise
        return self.scorer


def judge(requests: DataFrame, keep: tuple[str, ...] = ("request_id",)) -> DataFrame:
    """Request rows with ``reasons``; a label or any other unknown field is refused."""
    known = {f.name for f in REQUEST_FIELDS} | set(keep)
    unknown = [c for c in requests.columns if c not in known]
    return with_reasons(requests, REQUEST_FIELDS, forbidden=unknown)


def accepted_rows(judged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed and normalised rows that have no failure."""
    good = judged.where(F.size("reasons") == 0)
    names = {f.name for f in REQUEST_FIELDS}
    extra = [F.col(c) for c in keep if c not in names]
    casts = [f.typed().alias(f.name) for f in REQUEST_FIELDS]
    return normalize_request(good.select(*extra, *casts))


def score_stream(
    requests: DataFrame,
    champion: Champion,
    predictions_path: str,
    quarantine_path: str,
    checkpoint: str,
    keep: tuple[str, ...] = ("request_id",),
) -> StreamingQuery:
    """Validate, normalise, add history, score; bad rows go to quarantine with their reasons.

    Each micro-batch owns one folder that it overwrites, so a batch that runs again after a
    lost executor or driver replaces its own rows.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = judge(batch, keep).persist()
        try:
            scorer = champion.current()
            scored = scorer.score(accepted_rows(judged, keep), keep)
            scored.write.mode("overwrite").parquet(f"{predictions_path}/batch={batch_id}")
            bad = judged.where(F.size("reasons") > 0)
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        finally:
            judged.unpersist()

    return (
        requests.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class Log:
    """Predictions and refused requests of a stream, published batch by batch.

    A batch writes both tables under a name of its own and is published by one small file that
    appears by a rename, after them. Readers go by those files, so they see all of a batch or
    nothing of it. A batch that comes again after it was published changes nothing; one that failed
    before leaves files that nobody reads.
    """

    KINDS = ("predictions", "quarantine")

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        return jvm.org.apache.hadoop.fs.Path, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def published(self, batch: int) -> bool:
        Path, files = self._files()
        return files.exists(Path(f"{self.path}/commits/{batch}.json"))

    def publish(self, batch: int, predictions: DataFrame, quarantine: DataFrame) -> None:
        if self.published(batch):
            return
        attempt = uuid.uuid4().hex[:12]
        for kind, rows in zip(self.KINDS, (predictions, quarantine), strict=True):
            rows.write.parquet(f"{self.path}/{kind}/batch={batch}/attempt={attempt}")
        self.commit(batch, attempt)

    def commit(self, batch: int, attempt: str) -> None:
        Path, files = self._files()
        hidden = Path(f"{self.path}/commits/_{batch}-{attempt}")
        out = files.create(hidden)
        out.write(bytearray(json.dumps({"batch": batch, "attempt": attempt}) + "\n", "utf-8"))
        out.close()
        files.rename(hidden, Path(f"{self.path}/commits/{batch}.json"))

    def read(self, kind: str, schema: StructType) -> DataFrame:
        """All published rows of a kind, with their ``batch``."""
        Path, files = self._files()
        if not files.exists(Path(f"{self.path}/commits")):
            return self.spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("long"))
        # One small row per batch; old batches can be moved to a table of their own.
        known = self.spark.read.schema("batch long, attempt string").json(f"{self.path}/commits/*.json")
        named = StructType([*schema.fields, StructField("batch", LongType()), StructField("attempt", StringType())])
        every = self.spark.read.schema(named).option("basePath", f"{self.path}/{kind}").parquet(f"{self.path}/{kind}")
        return every.join(F.broadcast(known), ["batch", "attempt"], "left_semi").select(*[f"`{f.name}`" for f in schema.fields], "batch")


def score_stream_once(
    requests: DataFrame,
    champion: Champion,
    log: Log,
    checkpoint: str,
    key: str = "request_id",
    arrived: str = "received_at",
    late: str = "1 hour",
) -> StreamingQuery:
    """Score every request once: ones that are sent again within ``late`` are dropped, batches publish whole.

    Requests without a key are let through, as nothing tells them apart.
    """
    keep = (key, arrived)
    marked = requests.withWatermark(arrived, late)
    once = marked.where(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    rows = once.unionByName(marked.where(F.col(key).isNull()))

    def handle(batch: DataFrame, batch_id: int) -> None:
        if log.published(batch_id):
            return
        judged = judge(batch, keep).persist()
        try:
            scored = champion.current().score(accepted_rows(judged, keep), keep)
            log.publish(batch_id, scored, judged.where(F.size("reasons") > 0))
        finally:
            judged.unpersist()

    return (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_table(requests: DataFrame, scorer: Scorer, keep: tuple[str, ...] = ("request_id",)):
    """The batch form: (predictions, quarantine)."""
    judged = judge(requests, keep)
    bad = judged.where(F.size("reasons") > 0)
    return scorer.score(accepted_rows(judged, keep), keep), bad
