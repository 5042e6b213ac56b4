"""The ledger: append-only logs of gazettes, emitted hashes and the outbox, with views over them.

Every batch writes below its own batch directory, and a directory that exists is complete (Spark
renames on commit), so writing a batch twice is a no-op.  State is keyed by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GAZETTES = "sha256 string, gazette_id string, source_filename string, status string, artifact_dir string, page_count int, error_message string, at string, seq long"
EMITTED = "row_hash string, gazette_id string, notification_no string, sr_no string, at string"
OUTBOX = "id string, kind string, payload string, event string, error string, seq long"
NOTIFICATIONS = "gazette_id string, notification_no string, page_start int, page_end int, variant_hint string"


def clock(zone: str = "Asia/Kolkata"):
    """ISO time in the ledger's zone, as text."""
    return F.date_format(F.from_utc_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), zone), "yyyy-MM-dd'T'HH:mm:ss")


def latest_status(log: DataFrame) -> DataFrame:
    """Newest state per content hash.  ``artifact_dir`` and ``page_count`` keep their last known
    value; ``error_message`` is that of the newest entry, null included."""
    last = lambda c: F.max_by(c, "seq")
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq")))
    return log.groupBy("sha256").agg(
        F.min_by("gazette_id", "seq").alias("gazette_id"), last("source_filename").alias("source_filename"), last("status").alias("status"),
        known("artifact_dir").alias("artifact_dir"), known("page_count").alias("page_count"), last("error_message").alias("error_message"),
        F.min_by("at", "seq").alias("created_at"), last("at").alias("updated_at"),
    )


def stale_processing(status: DataFrame) -> DataFrame:
    """Gazettes that a crash left in processing, as failed entries to append."""
    return status.where(F.col("status") == "processing").select(
        "sha256", "gazette_id", "source_filename", F.lit("failed").alias("status"), "artifact_dir", "page_count", F.lit("Interrupted while processing").alias("error_message")
    )


def new_hashes(rows: DataFrame, emitted: DataFrame) -> DataFrame:
    """Rows whose hash was never emitted.  Equal hashes inside ``rows`` are all kept."""
    return rows.join(emitted.select("row_hash").distinct(), "row_hash", "left_anti")


def pending(outbox: DataFrame) -> DataFrame:
    """Queued entries that are not done: ``id, kind, payload, attempts, last_error``, oldest first."""
    state = outbox.groupBy("id").agg(
        F.max_by("kind", F.when(F.col("event") == "queued", F.col("seq"))).alias("kind"),
        F.max_by("payload", F.when(F.col("event") == "queued", F.col("seq"))).alias("payload"),
        F.min(F.when(F.col("event") == "queued", F.col("seq"))).alias("seq"),
        F.count_if(F.col("event") == "failed").alias("attempts"),
        F.max_by("error", F.when(F.col("event") == "failed", F.col("seq"))).alias("last_error"),
        F.bool_or(F.col("event") == "done").alias("done"),
    )
    return state.where(~F.col("done")).select("id", "kind", "payload", "seq", "attempts", "last_error").orderBy("seq", "id")


class Ledger:
    """Logs below one directory of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def read(self, name: str, schema: str) -> DataFrame:
        path, fs = self._path(name)
        if not fs.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.root}/{name}")

    def append(self, name: str, batch: str, df: DataFrame) -> bool:
        """Write one batch unless it is there already."""
        done, fs = self._path(f"{name}/{batch}/_SUCCESS")
        if fs.exists(done):
            return False
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/{batch}")
        return True

    def gazettes(self) -> DataFrame:
        return latest_status(self.read("gazettes", GAZETTES))

    def emitted(self) -> DataFrame:
        return self.read("emitted", EMITTED)

    def outbox(self) -> DataFrame:
        return self.read("outbox", OUTBOX)

    def set_status(self, batch: str, entries: DataFrame, seq: int) -> None:
        full = entries.withColumns({"at": clock(), "seq": F.lit(seq).cast("long")})
        columns = [c.split() for c in GAZETTES.split(", ")]
        self.append("gazettes", batch, full.select(*[(F.col(n) if n in full.columns else F.lit(None)).cast(t).alias(n) for n, t in columns]))

    def recover(self, batch: str, seq: int) -> None:
        stale = stale_processing(self.gazettes())
        if not stale.isEmpty():
            self.set_status(batch, stale, seq)

    def record(self, batch: str, items: DataFrame, outbox: DataFrame, seq: int) -> None:
        """Emitted hashes and queued entries of one batch.  The queue is written first: a crash in
        between emits the batch again and queues nothing twice, since ids come from the content."""
        order = Window.partitionBy("kind", "payload").orderBy(F.lit(1))
        ids = F.sha2(F.concat_ws("|", F.lit(batch), "kind", "payload", F.row_number().over(order).cast("string")), 256)
        queued = outbox.select(ids.alias("id"), "kind", "payload", F.lit("queued").alias("event"), F.lit(None).cast("string").alias("error"), F.lit(seq).cast("long").alias("seq"))
        self.append("outbox", batch, queued)
        self.append("emitted", batch, items.select("row_hash", "gazette_id", "notification_no", "sr_no", clock().alias("at")))

    def notifications(self, batch: str, spans: DataFrame) -> None:
        self.append("notifications", batch, spans.select(*[c.split()[0] for c in NOTIFICATIONS.split(", ")]))

    def drain(self, batch: str, sheet, seq: int, schemas: dict[str, str]) -> dict[str, str | None]:
        """Push pending entries kind by kind; a kind that fails stays queued and is counted."""
        todo, result = pending(self.outbox()).cache(), {}
        try:
            for (kind,) in [tuple(r) for r in todo.select("kind").distinct().orderBy("kind").collect()]:
                own = todo.where(F.col("kind") == kind)
                try:
                    sheet.append(kind, own.select(F.from_json("payload", schemas[kind]).alias("r")).select("r.*"))
                    event, error = "done", None
                except Exception as failure:
                    event, error = "failed", str(failure)[:2000]
                result[kind] = error
                entry = own.select("id", "kind", F.lit(None).cast("string").alias("payload"), F.lit(event).alias("event"), F.lit(error).cast("string").alias("error"), F.lit(seq).cast("long").alias("seq"))
                self.append("outbox", f"{batch}-{kind}-{event}", entry)
        finally:
            todo.unpersist()
        return result


def newest(status: DataFrame, state: str | None = None, limit: int = 50) -> DataFrame:
    """Newest gazettes first, optionally of one status."""
    found = status if state is None else status.where(F.col("status") == state)
    return found.orderBy(F.col("created_at").desc(), "sha256").limit(limit)
