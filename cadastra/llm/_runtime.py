"""Session helpers shared by the operators: scratch tables, size checks, task sizing.

Scratch tables live below the folder named by ``spark.checkpoint.dir`` so that every executor can
read them after another one is lost.  Only in local mode (tests, a laptop), where that setting may
be absent, is a folder of the driver's own used; on a cluster its absence is an error.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: str | None = None
_written: list[str] = []

#: Tables up to this many bytes may be broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 64 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="cadastra-scratch-")
    return "file://" + _own_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/cadastra/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete every scratch table that this driver wrote."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    try:
        if spark is not None:
            drop_scratch(spark)
    except Exception:  # the JVM may be gone already
        pass


def fits_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` (already materialized, so reading is cheap) holds at most ``limit`` bytes, by
    ``row_bytes`` a row and by the bytes of its values, whichever is more."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    found = df.limit(limit // row_bytes + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return max(found.n * row_bytes, found.bytes) <= limit


def maybe_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, row_bytes, limit) else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(key: Column, modulus: int) -> Column:
    """crc32 of the decimal text of ``key`` modulo ``modulus``: the fold rule for held-out rows."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Let Arrow batches hold at most about ``limit`` bytes (a longer row stands alone): a Python
    worker's memory then follows the longest text, not the number of rows of a batch."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    size, unit = int(now.rstrip("bkmgBKMG")), now.lstrip("0123456789").lower()[:1]
    if size <= 0 or size * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(unit, 1) > limit:
        spark.conf.set(key, str(limit))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
