"""Notification spans: page intervals that hold one notification.

All text work is done per page in columns.  The walk over the pages of a gazette is a fold over
flags, in the plan, so that no gazette needs a Python call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.config import EngineConfig
from cadastra.functions import text as tx


_FRESH = r"(?i)Notification\s+No\.?\s*([^\r\n]+)"


def _beyond_end(prose: Column, cfg: EngineConfig) -> Column:
    """What follows the earliest closing phrase; all of a text without one."""
    closing = [F.regexp_instr(prose, F.lit("(?i)" + p)) + F.length(F.regexp_extract(prose, "(?i)" + p, 0)) for p in cfg.span_end_patterns]
    ends = [F.when(prose.rlike("(?i)" + p), at) for p, at in zip(cfg.span_end_patterns, closing, strict=True)]
    earliest = F.least(*ends) if len(ends) > 1 else (ends[0] if ends else F.lit(None).cast("int"))
    return F.when(earliest.isNotNull(), F.substr(prose, earliest)).otherwise(prose)


def page_marks(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """What a page's own text says of it: ``page_flags`` before its tables are looked at."""
    prose = F.col("prose")
    return pages.withColumn("prose", tx.prose(F.coalesce("text", F.lit("")))).select(
        "gazette_id",
        "page_no",
        tx.matches_any(prose, cfg.anchor_patterns).alias("anchor"),
        tx.matches_any(prose, cfg.span_end_patterns).alias("closes"),
        tx.notification_no(prose).alias("notification_no"),
        tx.variant_hint(F.coalesce("text", F.lit(""))).alias("variant_hint"),
        _beyond_end(prose, cfg).rlike(_FRESH).alias("fresh"),
    )


def edge_marks(tables: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """Adds what the texts around a table say: ``body_before``, ``body_after``, ``anchor_after``, ``tail_fresh``."""
    body = lambda c: F.when(F.size(c) > 0, F.size(tx.body_text(F.col(c), cfg.running_text_patterns, cfg.running_text_max)) > 0)
    after = F.when(F.size("text_after") > 0, F.exists("text_after", lambda t: F.coalesce(tx.matches_any(t, cfg.anchor_patterns), F.lit(False))))
    none = lambda c: F.coalesce(c, F.lit(False))
    return tables.withColumns(
        {
            "body_before": none(body("text_before")),
            "body_after": none(body("text_after")),
            "anchor_after": none(after),
            "tail_fresh": none(F.array_join("text_after", "\n").rlike(_FRESH)),
        }
    )


def page_flags(pages: DataFrame, tables: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """Per page: ``anchor``, ``closes``, ``notification_no``, ``variant_hint``, ``ends_start`` and
    ``ends_any`` (the table ends here, as a span's first or as a later page), ``fresh`` (a new
    notification begins after the end)."""
    keyed = tables.where(F.col("page_no").isNotNull()).select(
        "gazette_id", "page_no", F.coalesce("idx", F.lit(0)).alias("idx"), "text_before", "text_after"
    )
    edge = keyed.groupBy("gazette_id", "page_no").agg(
        F.min_by(F.struct("text_before"), "idx").alias("first"), F.max_by(F.struct("text_after"), "idx").alias("last")
    )
    body = lambda c: F.size(tx.body_text(c, cfg.running_text_patterns, cfg.running_text_max)) > 0
    tabled = edge.select(
        "gazette_id",
        "page_no",
        body(F.col("first.text_before")).alias("body_before"),
        body(F.col("last.text_after")).alias("body_after"),
        F.exists(F.coalesce("last.text_after", F.array().cast("array<string>")), lambda t: tx.matches_any(t, cfg.anchor_patterns)).alias("anchor_after"),
        F.array_join(F.coalesce("last.text_after", F.array().cast("array<string>")), "\n").alias("tail"),
    )
    # the literal next page, looked up by the same key as the page's own table: one exchange serves both
    here = pages.select("gazette_id", "page_no", "text").join(tabled, ["gazette_id", "page_no"], "left")
    after = tabled.select("gazette_id", (F.col("page_no") - 1).alias("page_no"), F.col("body_before").alias("next_before"))
    both = here.join(after, ["gazette_id", "page_no"], "left").withColumn("prose", tx.prose(F.coalesce("text", F.lit(""))))
    has_table = F.col("body_after").isNotNull()
    ends_any = F.coalesce(has_table & (F.col("body_after") | F.coalesce("next_before", F.lit(True))), F.lit(False))
    rest = F.when(has_table, F.col("tail")).otherwise(_beyond_end(F.col("prose"), cfg))
    return both.select(
        "gazette_id",
        "page_no",
        tx.matches_any(F.col("prose"), cfg.anchor_patterns).alias("anchor"),
        tx.matches_any(F.col("prose"), cfg.span_end_patterns).alias("closes"),
        tx.notification_no(F.col("prose")).alias("notification_no"),
        tx.variant_hint(F.coalesce("text", F.lit(""))).alias("variant_hint"),
        (ends_any & ~F.coalesce("anchor_after", F.lit(False))).alias("ends_start"),
        ends_any.alias("ends_any"),
        rest.rlike(_FRESH).alias("fresh"),
    )


_SPAN = "struct<notification_no:string,page_start:int,page_end:int,variant_hint:string>"
_WALK = f"""
aggregate(
  pages,
  named_struct('done', cast(array() as array<{_SPAN}>), 'open', cast(null as {_SPAN})),
  (a, p) -> CASE
    WHEN a.open IS NOT NULL AND NOT (p.closes AND p.page_no > a.open.page_start + 1) AND NOT p.anchor AND NOT p.ends_any THEN
      named_struct('done', a.done, 'open', named_struct('notification_no', a.open.notification_no, 'page_start', a.open.page_start, 'page_end', p.page_no, 'variant_hint', a.open.variant_hint))
    ELSE transform(array(named_struct(
        'done', CASE WHEN a.open IS NULL THEN a.done
                     WHEN p.anchor AND NOT (p.closes AND p.page_no > a.open.page_start + 1) THEN concat(a.done, array(a.open))
                     ELSE concat(a.done, array(named_struct('notification_no', a.open.notification_no, 'page_start', a.open.page_start, 'page_end', p.page_no, 'variant_hint', a.open.variant_hint))) END,
        'starts', p.anchor AND (a.open IS NULL OR p.fresh OR NOT (p.closes AND p.page_no > a.open.page_start + 1)),
        'own', named_struct('notification_no', p.notification_no, 'page_start', p.page_no, 'page_end', p.page_no, 'variant_hint', p.variant_hint))),
      s -> named_struct(
        'done', CASE WHEN s.starts AND p.ends_start THEN concat(s.done, array(s.own)) ELSE s.done END,
        'open', CASE WHEN s.starts AND NOT p.ends_start THEN s.own END))[0]
  END,
  a -> CASE WHEN a.open IS NULL THEN a.done ELSE concat(a.done, array(a.open)) END)
"""


def find_spans(pages: DataFrame, tables: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """``gazette_id, span_id, notification_no, page_start, page_end, variant_hint``; spans of one
    gazette may share a page."""
    return walk_spans(page_flags(pages, tables, cfg))


def walk_spans(flags: DataFrame) -> DataFrame:
    listed = flags.groupBy("gazette_id").agg(
        F.array_sort(F.collect_list(F.struct("page_no", "anchor", "closes", "notification_no", "variant_hint", "ends_start", "ends_any", "fresh"))).alias("pages")
    )
    return listed.select("gazette_id", F.posexplode(F.expr(_WALK)).alias("span_id", "s")).select("gazette_id", "span_id", "s.*")


def tables_in_spans(tables: DataFrame, spans: DataFrame) -> DataFrame:
    """Tables joined to every span that holds their page (a shared page counts for both)."""
    dated = spans.select("gazette_id", "span_id", "notification_no", "page_start", "page_end", "variant_hint")
    inside = F.col("t.page_no").between(F.col("s.page_start"), F.col("s.page_end"))
    joined = tables.alias("t").join(dated.alias("s"), (F.col("t.gazette_id") == F.col("s.gazette_id")) & inside)
    return joined.select("t.*", *[f"s.{c}" for c in dated.columns if c != "gazette_id"])
