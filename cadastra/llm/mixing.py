"""Mixing sources to target weights with hash-threshold histograms: no sort, no collected rows.

Every source gets a target number of words: weights share ``ratio`` of all words, a target stops at
``most`` times the source's size and the excess is shared again by weight (water filling).  A target
of e epochs takes every document floor(e) times.  What is left of it, the rest budget, goes to the
documents whose hash lies below a threshold.

The threshold is found in nested histograms.  Words are summed by source and by the top ``bits`` of
the document's 60-bit hash; a running sum over the buckets (2^bits per source, whatever the size of
the input) finds the bucket in which the budget ends.  Only that bucket is histogrammed again, by
its next bits, until it holds one hash value.  The final pass is a plain filter against one number
per source.

Scale.  Texts are read once, for counting; the (id, source, size, hash) rows are kept as a table.
Each refinement reads only rows of boundary buckets.  Sums are map-side combined, so a hot source
spreads evenly.  The driver sees a row per *source* (targets depend on all sources at once) and
never a row per document.

Edge cases.  Null text: size 0.  Null source: a source of its own, last in order.  Rows of one id
have one hash: they are taken together or not at all.  Sources without words have target 0.  An
empty table gives an empty mix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt
from cadastra.llm import bytesops as bo

HASH_BITS = 60


def _count_batches(batches):
    for batch in batches:
        size = bo.count_words(*bo.text_buffers(batch.column(2)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size)], names=["id", "source", "size"])


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id``, ``source``, ``size`` in words, ``h``: 60 bits of the md5 of the id."""
    src = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    counted = src.mapInArrow(_count_batches, f"id {dict(src.dtypes)['id']}, source string, size long")
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    return counted.withColumn("h", F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long"))


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...], ratio: float, most: float) -> list[tuple[str | None, int, float]]:
    """(source, size, target): weights cycle over the sources in code-point order, null last."""
    ordered = sorted(sizes, key=lambda r: (r[0] is None, (r[0] or "").encode("utf-32-be")))
    size = np.array([s for _, s in ordered], float)
    weight = np.array([weights[i % len(weights)] for i in range(len(ordered))], float)
    cap, left, total = most * size, ratio * size.sum(), np.zeros(len(ordered))
    free = np.ones(len(ordered), bool)
    while free.any():
        share = np.where(free, left * weight / weight[free].sum(), 0)
        over = free & (share > cap)
        if not over.any():
            total[free] = share[free]
            break
        total[over] = cap[over]
        left -= cap[over].sum()
        free &= ~over
    return [(s, int(n), float(t)) for (s, n), t in zip(ordered, total, strict=True)]


def _threshold(rows: DataFrame, rest: DataFrame, bits: int) -> DataFrame:
    """Per source the first hash that is not taken any more: ``source``, ``cut``."""
    cut = rest.select("source", F.col("rest").alias("left"), F.lit(0).cast("long").alias("lo"))
    level = HASH_BITS
    while level > 0:
        step = min(bits, level)
        level -= step
        open_ = cut.where(F.col("left") >= 0)
        inside = rows.join(F.broadcast(open_) if rt.fits_broadcast(open_, 64) else open_, rows["source"].eqNullSafe(open_["source"])).where(
            F.shiftright("h", level + step) == F.shiftright("lo", level + step)
        ).select(open_["source"].alias("source"), "left", "lo", "size", F.shiftright("h", level).alias("bucket"))
        hist = inside.groupBy("source", "left", "lo", "bucket").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        run = hist.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("bucket")))
        # the first bucket that the budget does not cover; without one, all of this range is taken
        past = run.where(F.col("upto") > F.col("left")).groupBy("source").agg(F.min(F.struct("bucket", "upto", "size", "n", "left")).alias("b"))
        after = past.select(
            "source",
            (F.col("b.left") - F.col("b.upto") + F.col("b.size")).alias("left"),
            F.shiftleft(F.col("b.bucket"), level).alias("lo"),
            F.col("b.n").alias("n"),
        )
        prior = cut.select(F.col("source").alias("was"), F.col("left").alias("left0"), F.col("lo").alias("lo0"))
        end = F.shiftleft(F.shiftright("lo0", level + step) + 1, level + step)
        # without a bucket past the budget all of the range is taken and the source is done (left = -1)
        merged = prior.join(after, prior["was"].eqNullSafe(after["source"]), "left").select(
            F.col("was").alias("source"),
            F.when(F.col("n").isNull(), F.lit(-1.0)).otherwise(F.col("left")).alias("left"),
            F.when(F.col("n").isNull() & (F.col("left0") >= 0), end).otherwise(F.coalesce("lo", "lo0")).alias("lo"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        merged = rt.materialize(merged, "cut")
        cut = merged.select("source", "left", "lo")
        if merged.where(F.col("n") > 1).isEmpty():
            break
    return cut.select("source", F.col("lo").alias("cut"))


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = (5, 2, 1),
    ratio: float = 1.5,
    most: float = 2.0,
    bits: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row: id, ``size``, ``source_size``, ``target`` of its source, ``epochs`` (times the
    document is taken), ``taken`` = size x epochs."""
    spark = docs.sparkSession
    rows = rt.materialize(sized(docs, id_col, text_col, source_col), "sized")
    per = [(r.source, r.size) for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    plan = []
    for source, size, target in targets(per, weights, ratio, most):
        whole = int(target // size) if size else 0
        plan.append((source, size, target, whole, target - whole * size))
    plan_df = rt.materialize(spark.createDataFrame(plan, "source string, source_size long, target double, whole long, rest double"), "plan")
    cut = _threshold(rows, plan_df, bits)
    full = plan_df.join(cut.withColumnRenamed("source", "s2"), plan_df["source"].eqNullSafe(F.col("s2")), "left").drop("s2").withColumnRenamed("source", "of")
    full = rt.materialize(full, "plan")
    epochs = F.col("whole") + F.when(F.col("h") < F.col("cut"), 1).otherwise(0)
    return rows.join(F.broadcast(full) if rt.fits_broadcast(full, 96) else full, rows["source"].eqNullSafe(full["of"])).select(
        F.col("id").alias(id_col), "size", "source_size", "target", epochs.cast("long").alias("epochs"), (F.col("size") * epochs).cast("long").alias("taken")
    )


def op8(spark, sf_dir: str) -> DataFrame:
    return mix(rt.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:15] AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, sum(size) AS size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
o AS (
  SELECT *, 2.0 * size AS cap, row_number() OVER (ORDER BY 2.0 * size / w, source NULLS LAST) AS place, coalesce(sum(2.0 * size) OVER before, 0) AS spent, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS wleft,
         1.5 * sum(size) OVER () AS total
  FROM s WINDOW before AS (ORDER BY 2.0 * size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min((total - spent) / wleft, place) AS l FROM o WHERE (total - spent) * w / wleft <= cap),
t AS (SELECT source, CAST(size AS BIGINT) AS source_size, CAST(least(cap, w * l) AS DOUBLE) AS target FROM o, level),
r AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(size * (whole + CASE WHEN upto <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
