"""Artifact and inbox sources.

The engine's own layout is Parquet partitioned by ``gazette_id`` (``meta``, ``pages``, ``tables``).
``read_json_layout`` reads directories of ``<gazette_id>/meta.json``, ``pages/NNNN.txt`` and
``tables/t*.json`` through Spark's readers, so any file system will do."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.functions import scalars as sc
from cadastra.functions.text import page_class


class Parser(Protocol):
    """A document parser: files (``path, gazette_id``) to ``pages`` and ``tables`` of the engine's schemas."""

    def __call__(self, files: DataFrame) -> tuple[DataFrame, DataFrame]: ...


def read_json_layout(spark: SparkSession, root: str, gazette_id: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``meta``, ``pages`` and ``tables``; a single gazette reads only its own directory."""
    base = f"{root}/{gazette_id or '*'}"
    file = F.col("_metadata.file_path")
    owner = lambda depth: F.url_decode(F.element_at(F.split(file, "/"), -depth))
    meta = spark.read.schema("source_filename string, sha256 string, page_count int").json(f"{base}/meta.json", multiLine=True)
    meta = meta.select(owner(2).alias("gazette_id"), "*")
    texts = spark.read.text(f"{base}/pages/*.txt", wholetext=True)
    pages = texts.select(owner(3).alias("gazette_id"), F.regexp_extract(file, r"(\d+)\.txt$", 1).try_cast("int").alias("page_no"), F.col("value").alias("text"))
    fields = ", ".join(c for c in schemas.TABLES.replace("idx int", "index int").split(", ") if not c.startswith("gazette_id"))
    raw = spark.read.schema(fields).json(f"{base}/tables/*.json", multiLine=True)
    tables = raw.select(owner(3).alias("gazette_id"), F.col("index").alias("idx"), *[c.split()[0] for c in fields.split(", ") if not c.startswith("index")])
    return meta, pages, tables


def write_artifacts(root: str, meta: DataFrame, pages: DataFrame, tables: DataFrame) -> None:
    """Write the Parquet layout.  Each table's partitions are replaced as a whole and committed by
    Spark's protocol; ``meta`` goes last, so a gazette with meta is complete."""
    for name, df in (("pages", pages), ("tables", tables), ("meta", meta)):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("gazette_id").parquet(f"{root}/{name}")


def read_artifacts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``meta``, ``pages`` and ``tables`` of the Parquet layout; filters on gazette_id prune."""
    found = []
    for name, schema in (("meta", schemas.META), ("pages", schemas.PAGES), ("tables", schemas.TABLES)):
        found.append(spark.read.schema(schema).parquet(f"{root}/{name}"))
    return tuple(found)


def complete_gazettes(meta: DataFrame) -> DataFrame:
    return meta.select("gazette_id").distinct()


def page_range(pages: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Pages start..end, both included; numbers stay as they are."""
    return pages if start is None else pages.where(F.col("page_no").between(start, end if end is not None else start))


def parse_page_range(text: str | None) -> tuple[int, int] | None:
    """``"1-5"`` or ``"3"``."""
    if not text:
        return None
    lo, _, hi = text.partition("-")
    return int(lo), int(hi or lo)


def classify_pages(pages: DataFrame, below: int = 50) -> DataFrame:
    """Adds ``n_chars`` and ``page_class`` (scanned or digital)."""
    return pages.withColumns({"n_chars": F.length(F.coalesce("text", F.lit(""))), "page_class": page_class(F.col("text"), below)})


def inbox(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Files of a directory (not below it) by content: ``path, sha256, gazette_id`` and the
    metadata of the name.  Of equal files the first by path counts, the others are ``skipped``."""
    from pyspark.sql import Window

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    name = F.url_decode(F.element_at(F.split("path", "/"), -1))
    digest = files.select("path", F.sha2("content", 256).alias("sha256"), name.alias("source_filename"))
    stem = F.regexp_replace("source_filename", r"\.[^.]*$", "")
    order = Window.partitionBy("sha256").orderBy("path")
    ids = digest.withColumns({"gazette_id": sc.gazette_id(stem, F.col("sha256")), "meta": sc.filename_meta(F.col("source_filename")), "skipped": F.row_number().over(order) > 1})
    return ids.select("path", "sha256", "source_filename", "gazette_id", "meta.*", "skipped")


def pending(files: DataFrame, status: DataFrame) -> DataFrame:
    """Files whose content no completed gazette has."""
    done = status.where(F.col("status") == "completed").select("sha256").distinct()
    return files.where(~F.col("skipped")).join(done, "sha256", "left_anti")


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def move_files(spark: SparkSession, outcomes: DataFrame, processed_dir: str, failed_dir: str) -> None:
    """Move each file (``path, outcome``) to the folder of its outcome; a file of that name there is
    replaced, one that is there already or gone stays."""
    for r in outcomes.select("path", "outcome").toLocalIterator():
        source, fs = _fs(spark, r.path)
        folder = _fs(spark, failed_dir if r.outcome == "failed" else processed_dir)[0]
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, source.getName())
        if not fs.exists(source) or fs.makeQualified(source).equals(fs.makeQualified(target)):
            continue
        fs.mkdirs(folder)
        fs.delete(target, False)
        if not fs.rename(source, target):
            raise OSError(f"cannot move {r.path} to {folder}")
