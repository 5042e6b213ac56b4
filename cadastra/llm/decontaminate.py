"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A benchmark item is cut into windows of ``window`` consecutive words (an item that has fewer words
is one window).  A window is a set of positioned shingles.  For exact containment the necessary
prefix of such a set is a single element, so each window is indexed under its *rarest* shingle,
rarity being the number of occurrences in the whole corpus.  Document positions are joined to that
index by the shingle's hash; the shingle's place in the window gives the only possible start, the
length bound drops starts that would leave the text, and the words of the item-sized window are
then compared one for one.

Scale.  Two scans of ``text`` and one shuffle of narrow rows (a row per document plus a row per
verified hit).  Both indexes grow with the benchmark, never with the corpus; they are broadcast
only below ``broadcast_bytes`` and joined by shuffle beyond that.

Edge cases.  A null text, or one without words, has no words and no hits.  A null item text or an
item without words has no windows.  Repeated rows are judged row by row: the result has as many
rows as ``docs``.  A null ``doc_id`` is kept.  Columns other than the id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words once case is ignored: every ASCII character but letters and digits.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP_CHARS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text: Column) -> Column:
    """Words of ``text`` in their own case; an empty array for null or no words."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_GAP_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _GAP))


def _shingle(words: Column, at: Column, k: int) -> Column:
    """Candidate key of ``k`` words from ``at``.  Full lower-casing is coarser than the A-Z rule,
    so no true match is lost; the exact comparison comes later."""
    return F.xxhash64(*[F.lower(F.get(words, at + i)) for i in range(k)])


def item_windows(benchmark: DataFrame, window: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: ``body`` (words joined by a space), ``width``, ``items`` that contain it."""
    words = benchmark.select(
        F.col(item_col).cast("string").alias("item"), words_of(ascii_lower(F.col(text_col))).alias("words")
    ).where(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(window))
    starts = words.select("item", "words", width.alias("width"), F.explode(F.sequence(F.lit(1), F.size("words") - width + 1)).alias("s"))
    bodies = starts.select("item", "width", F.array_join(F.slice("words", F.col("s"), F.col("width")), " ").alias("body"))
    return bodies.groupBy("body", "width").agg(F.collect_set("item").alias("items"))


def _positions(docs: DataFrame, k: int, first: int) -> DataFrame:
    """A row per position from ``first`` with the key of the ``k``-word shingle there."""
    at = docs.select("*", F.explode(F.sequence(F.lit(first), F.greatest(F.size("words") - k, F.lit(first)))).alias("at"))
    return at.withColumn("key", F.when((F.col("at") >= 0) & (F.col("at") + k <= F.size("words")), _shingle(F.col("words"), F.col("at"), k)))


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    shingle: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = rt.BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_hit``, ``items`` (sorted ids as strings),
    ``spans`` (merged half-open word ranges that are hit), ``contaminated``."""
    windows = rt.materialize(item_windows(benchmark, window, item_col, item_text_col), "windows")
    parts = windows.select(
        "body", "width", F.least("width", F.lit(shingle)).alias("k"), F.split("body", " ").alias("ws")
    ).select("*", F.explode(F.sequence(F.lit(0), F.col("width") - F.col("k"))).alias("offset"))
    sizes = sorted(r.k for r in windows.select(F.least("width", F.lit(shingle)).alias("k")).distinct().collect())
    keyed = {
        k: parts.where(F.col("k") == k).select("body", "offset", _shingle(F.col("ws"), F.col("offset"), k).alias("key")) for k in sizes
    }
    text = docs.select(words_of(F.col(text_col)).alias("words"))

    def hint(df: DataFrame) -> DataFrame:
        return rt.maybe_broadcast(df, 64 + 24 * window, broadcast_bytes)

    # Scan 1: corpus-wide frequency of the benchmark's shingles, summed map-side before the shuffle.
    prefix = {}
    for k in sizes:
        wanted = rt.materialize(keyed[k].select("key").distinct(), "shingles")
        counts = _positions(text, k, 0).select("key").join(hint(wanted), "key").groupBy("key").agg(F.count("*").alias("seen"))
        rare = (
            keyed[k]
            .join(counts, "key", "left")
            .groupBy("body")
            .agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "key")).alias("r"))
            .where("r.seen > 0")
        )
        prefix[k] = rt.materialize(
            rare.join(windows, "body").select("body", "width", "items", F.col("r.offset").alias("offset"), F.col("r.key").alias("key")), "prefix"
        )

    # Scan 2: join the prefix shingles, bound, verify.  Position -1 carries the document itself.
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words")
    )
    nowhere = F.lit(None)
    found = []
    for n, k in enumerate(sizes or [0]):
        if not sizes:
            found.append(
                rows.select("rid", "id", F.size("words").alias("n_words"), nowhere.cast("int").alias("s"), nowhere.cast("int").alias("w"), nowhere.cast("array<string>").alias("items"))
            )
            break
        index = hint(prefix[k])
        small = rt.fits_broadcast(prefix[k], 64 + 24 * window, broadcast_bytes)
        at = _positions(rows, k, -1 if n == 0 else 0)
        if small:
            cut = at.withColumn("base", F.lit(0))
        else:  # the words must travel with the key: only those that a window through it can reach
            base = F.greatest(F.col("at") - window, F.lit(0))
            cut = at.withColumn("base", base).withColumn("near", F.slice("words", base + 1, 2 * window + k))
        n_words = F.size("words")
        cut = cut.select("rid", "id", n_words.alias("n_words"), "at", "key", "base", F.col("words" if small else "near").alias("body_words"))
        s = F.col("at") - F.col("offset")
        inside = (s >= 0) & (s + F.col("width") <= F.col("n_words"))
        same = F.col("body") == ascii_lower(F.array_join(F.slice("body_words", s - F.col("base") + 1, F.col("width")), " "))
        hit = F.coalesce(F.when(inside, same), F.lit(False))
        joined = cut.join(index, "key", "left" if n == 0 else "inner").where(hit | (F.col("at") == -1))
        found.append(
            joined.select(
                "rid", "id", "n_words", F.when(hit, s).alias("s"), F.when(hit, F.col("width")).alias("w"), F.when(hit, F.col("items")).alias("items")
            )
        )
    each = reduce(DataFrame.unionByName, found)
    per_doc = each.groupBy("rid", "id").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("s").isNotNull(), F.struct("s", (F.col("s") + F.col("w")).alias("e"))))).alias("raw"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    merged = F.expr(
        "aggregate(raw, cast(array() as array<struct<s:int,e:int>>), (acc, x) ->"
        " if(size(acc) > 0 and get(acc, size(acc) - 1).e >= x.s,"
        " concat(slice(acc, 1, size(acc) - 1), array(struct(get(acc, size(acc) - 1).s as s, greatest(get(acc, size(acc) - 1).e, x.e) as e))),"
        " concat(acc, array(x))))"
    )
    spans = per_doc.withColumn("spans", F.when(F.size("raw") > 0, merged).otherwise(F.array().cast("array<struct<s:int,e:int>>")))
    return spans.select(
        F.col("id").alias(id_col),
        "n_words",
        F.expr("aggregate(spans, 0L, (n, x) -> n + x.e - x.s)").alias("n_hit"),
        "items",
        "spans",
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", broadcast_bytes: int = rt.BROADCAST_BYTES, **options) -> DataFrame:
    """``docs`` without the documents that contain a benchmark window."""
    hit = find_hits(docs, benchmark, id_col=id_col, broadcast_bytes=broadcast_bytes, **options)
    ids = rt.materialize(hit.where("contaminated").select(F.col(id_col).alias("_hit_id")).distinct(), "contaminated")
    return docs.join(rt.maybe_broadcast(ids, 64, broadcast_bytes), docs[id_col].eqNullSafe(ids["_hit_id"]), "left_anti")


def op1(spark, sf_dir: str) -> DataFrame:
    hits = find_hits(rt.table(spark, sf_dir, "documents"), rt.table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS width, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS body
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT width FROM win),
pos AS (
  SELECT rid, width, s, array_to_string(w[s : s + width - 1], ' ') AS body
  FROM (SELECT d.rid, d.w, x.width, unnest(generate_series(1, len(d.w) - x.width + 1)) AS s FROM d, widths x WHERE len(d.w) >= x.width)),
hit AS (SELECT pos.rid, pos.s, pos.width, win.item FROM pos JOIN win ON pos.body = win.body AND pos.width = win.width),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(generate_series(s, s + width - 1)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (rid) LEFT JOIN items i USING (rid)
"""
