"""Micro-batch processing of gazettes whose artifacts are there: extract, validate, emit once."""

from __future__ import annotations

import logging
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.config import EngineConfig
from cadastra.operators import mapping, records
from cadastra.plans.extract import extract
from cadastra.sources import artifacts
from cadastra.sources.sinks import FileSink
from cadastra.streaming.ledger import Ledger, new_hashes, pending

log = logging.getLogger(__name__)
_PLOT = "gazette_id string, notification_no string, sr_no string, survey_number string, is_part boolean, village string, taluka string, row_hash string"
_REVIEW = "reason string, severity string, gazette_id string, sr_no string, survey_raw string"
PAYLOADS = {"rows": schemas.APPLICATION, "plots": _PLOT, "review": _REVIEW}


class RecordFailure(Exception):
    """The ledger failed: what was queued may stand, so the batch must not be queued again in parts."""


class Pipeline:
    """One call of ``process`` is one batch; a batch id may be replayed without effect.

    A batch that fails is halved by a hash of the gazette until the failing gazettes stand alone: the
    others complete.  Of two gazettes of equal content in a batch the first by id counts."""

    def __init__(self, spark: SparkSession, cfg: EngineConfig = EngineConfig(), sheet=None, notifier=None, transport=None):
        self.spark, self.cfg, self.sheet, self.notifier = spark, cfg, sheet, notifier
        self.transport = transport or mapping.transport_of(cfg)
        self.ledger = Ledger(spark, cfg.ledger_dir)
        self.files = FileSink(cfg.out_dir)

    def process(self, meta: DataFrame, pages: DataFrame, tables: DataFrame, batch: str | None = None) -> DataFrame:
        """Result rows: ``gazette_id, outcome, rows, plots, review_issues, reason``."""
        batch, seq = batch or uuid.uuid4().hex, time.time_ns()
        self.ledger.recover(f"{batch}-recover", seq)
        done = self.ledger.gazettes().where(F.col("status") == "completed").select("sha256", F.lit(True).alias("done"))
        again = F.row_number().over(Window.partitionBy("sha256").orderBy("gazette_id")) > 1
        # the content hash may be unknown: such gazettes are copies of nothing
        copy = F.col("sha256").isNotNull() & (F.coalesce("done", F.lit(False)) | F.col("again"))
        judged = meta.withColumn("again", again).join(done, "sha256", "left").withColumn("copy", copy).drop("done", "again").cache()
        fresh, copies = judged.where(~F.col("copy")).drop("copy"), judged.where("copy")
        skipped = copies.select("gazette_id", F.lit("skipped").alias("outcome"), F.lit("duplicate").alias("reason"))
        skipped = self.spark.createDataFrame(skipped.toArrow(), "gazette_id string, outcome string, reason string")
        try:
            entry = fresh.select("sha256", "gazette_id", "source_filename", "page_count")
            self.ledger.set_status(f"{batch}-processing", entry.withColumn("status", F.lit("processing")), seq)
            result = self._attempt(fresh, pages, tables, batch, seq + 1, 0)
        finally:
            judged.unpersist()
        return result.unionByName(skipped, allowMissingColumns=True)

    def _attempt(self, fresh: DataFrame, pages: DataFrame, tables: DataFrame, batch: str, seq: int, depth: int) -> DataFrame:
        entry = fresh.select("sha256", "gazette_id", "source_filename", "page_count")
        try:
            return self._complete(fresh, pages, tables, entry, batch, seq)
        except Exception as failure:
            if depth < 63 and not isinstance(failure, RecordFailure) and fresh.limit(2).count() > 1:
                log.warning("batch %s failed and is halved: %s", batch, failure)
                bit = F.shiftrightunsigned(F.xxhash64("gazette_id"), depth).bitwiseAND(1)
                halves = [self._attempt(fresh.where(bit == k), pages, tables, f"{batch}{k}", seq + 1, depth + 1) for k in (0, 1)]
                return halves[0].unionByName(halves[1], allowMissingColumns=True)
            text = str(failure)[:2000]
            self.ledger.set_status(f"{batch}-failed", entry.withColumns({"status": F.lit("failed"), "error_message": F.lit(text)}), seq + 2)
            result = fresh.select("gazette_id", F.lit("failed").alias("outcome"), F.lit(text).alias("reason"))
            result = self.spark.createDataFrame(result.toArrow(), "gazette_id string, outcome string, reason string")
            for r in result.toLocalIterator():
                self._send(f"Gazette 39A — processing failed ({r.gazette_id})", f"Gazette {r.gazette_id} failed:\n\n{failure}")
            return result

    def _complete(self, fresh: DataFrame, pages: DataFrame, tables: DataFrame, entry: DataFrame, batch: str, seq: int) -> DataFrame:
        mine, held = fresh.select("gazette_id"), []

        def keep(df: DataFrame) -> DataFrame:
            held.append(df.cache())
            return held[-1]

        try:
            found = extract(fresh, pages.join(mine, "gazette_id", "left_semi"), tables.join(mine, "gazette_id", "left_semi"), self.cfg, self.transport)
            seen, good, issues = keep(found["rows"]), keep(found["good"]), keep(found["issues"])
            emitted = self.ledger.emitted()
            rows, plots = keep(new_hashes(good, emitted)), keep(new_hashes(found["plots"], emitted))
            self.files.append_rows(rows, plots, issues, batch)
            key = ["row_hash", "gazette_id", "notification_no", "sr_no"]
            queue = records.tagged_records(rows, plots, issues)
            # without a sheet nothing is queued for one
            queue = queue if self.sheet is not None else queue.limit(0)
            counts = [df.groupBy("gazette_id").agg(F.count("*").alias(n)) for n, df in (("extracted", seen), ("rows", rows), ("plots", plots), ("review_issues", issues))]
            result = mine
            for c in counts:
                result = result.join(c, "gazette_id", "left")
            # fixed before the hashes are recorded, as ``rows`` leaves out what was emitted
            result = self.spark.createDataFrame(result.na.fill(0).withColumn("outcome", F.lit("completed")).toArrow())
            mails = self._mails(records.digest(rows, issues), result) if self.notifier is not None else []
            try:
                self.ledger.record(batch, rows.select(*key).unionByName(plots.select(*key)), queue, seq)
            except Exception as failure:
                raise RecordFailure(str(failure)) from failure
            errors = self.sync(f"{batch}-sync")
            self.ledger.set_status(f"{batch}-completed", entry.withColumn("status", F.lit("completed")), seq + 1)
            warning = self._warning(errors)
            for subject, head, body in mails:
                self._send(subject, "\n".join([*head, *warning, *body]).rstrip())
            return result.drop("extracted")
        finally:
            for df in held:
                df.unpersist()

    def _mails(self, digests: DataFrame, result: DataFrame) -> list[tuple[str, list[str], list[str]]]:
        """Subject, first lines and body by gazette.  Digests hold at most 20 lines of each kind."""
        mails = [(d.subject, [f"Gazette: {d.gazette_id}", ""], [*d.lines, "", *d.review_lines]) for d in digests.toLocalIterator()]
        # Fixed value: what reviewers read when a gazette holds no application.
        hint = "No 39A application rows were found. If this gazette contains a 39A notification, the table was probably not detected — check the PDF."
        for r in result.where("extracted = 0").select("gazette_id").toLocalIterator():
            mails.append(("Gazette 39A — no rows found", [f"Gazette: {r.gazette_id}", "", hint, ""], []))
        return mails

    def _warning(self, errors: dict[str, str | None]) -> list[str]:
        error = next((e for e in errors.values() if e), None)
        if error is None:
            return []
        n = pending(self.ledger.outbox()).count()
        return [f"WARNING: the sheet upload failed; {n} record(s) are queued and will be retried on the next run ({error}).", ""]

    def sync(self, batch: str | None = None) -> dict[str, str | None]:
        """Push the outbox to the sheet; per kind the error, or None."""
        if self.sheet is None:
            return {}
        return self.ledger.drain(batch or uuid.uuid4().hex, self.sheet, time.time_ns(), PAYLOADS)

    def process_inbox(self, parse: artifacts.Parser, batch: str | None = None, pattern: str = "*.pdf") -> DataFrame:
        """Process the inbox's files that no completed gazette has, and move them out of it.

        ``parse`` turns files into pages and tables; a gazette whose artifacts are there is not parsed again."""
        self.sync()
        files = artifacts.inbox(self.spark, self.cfg.inbox_dir, pattern)
        todo = artifacts.pending(files, self.ledger.gazettes()).cache()
        try:
            root = self.cfg.gazettes_dir
            stored = artifacts.complete_gazettes(artifacts.read_artifacts(self.spark, root)[0]) if artifacts.exists(self.spark, f"{root}/meta") else None
            unread = todo if stored is None else todo.join(stored, "gazette_id", "left_anti")
            if stored is None or not unread.isEmpty():
                pages, tables = parse(unread)
                counted = pages.groupBy("gazette_id").agg(F.count("*").cast("int").alias("page_count"))
                meta = unread.join(counted, "gazette_id", "left").select("gazette_id", "source_filename", "sha256", F.coalesce("page_count", F.lit(0)).alias("page_count"))
                artifacts.write_artifacts(root, meta, pages, tables)
            ids = todo.select("gazette_id")
            result = self.process(*[df.join(ids, "gazette_id", "left_semi") for df in artifacts.read_artifacts(self.spark, root)], batch)
            artifacts.move_files(self.spark, todo.select("path", "gazette_id").join(result.select("gazette_id", "outcome"), "gazette_id"), self.cfg.processed_dir, self.cfg.failed_dir)
            return result
        finally:
            todo.unpersist()

    def _send(self, subject: str, body: str) -> None:
        if self.notifier is None:
            return
        try:
            self.notifier.send(subject, body)
        except Exception:
            log.exception("notification failed; the outcome stands")


def stream_new_rows(stream: DataFrame, emitted_path: str, checkpoint: str, key: str = "row_hash", once: bool = True, every: str = "5 seconds"):
    """Exactly-once rows of a stream: each micro-batch appends the rows whose key was never
    emitted, below a directory named by its batch id, so that a replayed batch replaces itself."""

    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(emitted_path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        other = [str(s.getPath()) for s in fs.listStatus(root) if s.getPath().getName() != f"batch={batch_id}"] if fs.exists(root) else []
        one = df.dropDuplicates([key])
        fresh = one.join(spark.read.parquet(*other).select(key), key, "left_anti") if other else one
        fresh.write.mode("overwrite").parquet(f"{emitted_path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
