"""Tables that run across pages: column repair, chains, stitching, headers."""

from __future__ import annotations

from collections.abc import Iterable
from difflib import SequenceMatcher
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.config import EngineConfig
from cadastra.functions import cells as ce
from cadastra.functions import text as tx

_SR = r"^\s*(\d{1,3})\s*[.)]?(?:\s|$)"
_INNER_SR = r"(?U)\s(\d{1,3})\.\s+(?=\d)"


def split_first_column(tables: DataFrame) -> DataFrame:
    """Take the serial number out of the survey cell where both columns were read as one; numbers
    found at the start of a cell are listed in ``suspect_sr``."""
    first = lambda r: tx.strip(F.get(r, F.lit(0)))
    rest = lambda r: F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0)))
    none = lambda r: F.transform(rest(r), lambda c: F.lit(""))

    def repaired(r: Column) -> Column:
        c = first(r)
        lead = F.regexp_extract(c, _SR, 0)
        at = F.regexp_instr(c, F.lit(_INNER_SR))
        inner = F.regexp_extract(c, _INNER_SR, 0)
        return (
            F.when((F.size(r) == 0) | ce.is_marker_row(r), F.array(F.concat(F.array(F.lit("")), r)))
            .when(c.rlike(_SR), F.array(F.concat(F.array(tx.strip(lead), tx.strip(F.substr(c, F.length(lead) + 1))), rest(r))))
            .when(
                c.rlike(_INNER_SR),
                F.array(
                    F.concat(F.array(F.lit(""), tx.strip(F.substr(c, F.lit(1), at - 1))), none(r)),
                    F.concat(F.array(F.concat(F.regexp_extract(c, _INNER_SR, 1), F.lit(".")), tx.strip(F.substr(c, at + F.length(inner)))), rest(r)),
                ),
            )
            .otherwise(F.array(F.concat(F.array(F.lit(""), c), rest(r))))
        )

    folded = ce.folds_first_column(F.col("header"))
    grid = F.coalesce("grid", F.array().cast("array<array<string>>"))
    n_cols = F.coalesce("n_cols", F.lit(0))
    suspects = F.filter(
        F.transform(grid, lambda r: F.when((F.size(r) > 0) & ~ce.is_marker_row(r), F.regexp_extract(first(r), _SR, 1).try_cast("int"))), lambda n: n.isNotNull()
    )
    return tables.withColumns(
        {
            "grid": F.when(folded, F.flatten(F.transform(grid, repaired))).otherwise(grid),
            "header": F.when(folded, F.transform(F.sequence(F.lit(1), n_cols + 1), lambda i: i.cast("string"))).otherwise(F.col("header")),
            "n_cols": n_cols + folded.cast("int"),
            "suspect_sr": F.when(folded, suspects).otherwise(F.array().cast("array<int>")),
        }
    )


def _text_header(header: Column, grid: Column) -> Column:
    named = header.isNotNull() & F.exists(F.coalesce(header, F.array().cast("array<string>")), lambda c: ~tx.blank(c)) & ~ce.is_column_number_row(header)
    top = F.get(grid, F.lit(0))
    return F.when(F.coalesce(named, F.lit(False)), header).when(ce.is_text_header_row(top), top)


def chain_numbers(rows: Iterable[tuple], ratio: float) -> list[int]:
    """Chain number of each table of a span, in order; the state is the chain's head and its last number.
    Tables: page, columns, text before, text after, heading, first and last serial number."""
    chain, prev, head, last, out = -1, None, None, None, []
    for page_no, n_cols, body_before, body_after, own_head, first_sr, last_sr in rows:
        joins = (
            prev is not None
            and page_no is not None
            and prev[0] is not None
            and page_no == prev[0] + 1
            and n_cols == prev[1]
            and not prev[2]
            and not body_before
            and (own_head is None or head is not None and _alike(own_head, head, ratio))
            and not (last is not None and first_sr is not None and first_sr <= last)
        )
        if not joins:
            chain, head, last = chain + 1, own_head, None
        last = last_sr if last_sr is not None else last
        prev = page_no, n_cols, body_after
        out.append(chain)
    return out


def _alike(a: str, b: str, ratio: float) -> bool:
    return a == b or SequenceMatcher(None, a, b).ratio() >= ratio


def _chain_ids(ratio: float):
    @F.arrow_udf("array<int>")
    def run(spans: pa.Array) -> pa.Array:
        rows = zip(*(f.to_pylist() for f in spans.flatten().flatten()), strict=True)
        sizes = spans.value_lengths().to_pylist()
        out = [c for n in sizes for c in chain_numbers(islice(rows, n), ratio)]
        ends = pa.array([0, *accumulate(sizes)], pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(out, pa.int32()))

    return run


def stitch(span_tables: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """One row per logical table: keys of its span, ``table_seq``, ``header``, ``rows``,
    ``suspect_sr``.  Input: rows of ``tables_in_spans``."""
    body = lambda c: F.size(tx.body_text(c, cfg.running_text_patterns, cfg.running_text_max)) > 0
    fixed = split_first_column(span_tables)
    numbers = F.filter(F.transform("grid", ce.row_sr), lambda n: n.isNotNull())
    top = F.get("grid", F.lit(0))
    # a repeated header is dropped from every table but a chain's first
    repeats = (F.size("grid") > 0) & ce.is_header_like(top)
    body_grid = lambda t: F.when(t["repeats"], F.slice(t["grid"], 2, F.greatest(F.size(t["grid"]) - 1, F.lit(1)))).otherwise(t["grid"])
    later = body_grid({"repeats": F.col("repeats"), "grid": F.col("grid")})
    described = fixed.withColumns({"numbers": numbers, "repeats": repeats}).select(
        "gazette_id",
        "span_id",
        "notification_no",
        "page_start",
        "page_end",
        "variant_hint",
        F.struct(
            F.coalesce("page_no", F.lit(0)).alias("page_key"),
            F.coalesce("idx", F.lit(0)).alias("idx_key"),
            "page_no",
            "n_cols",
            body(F.col("text_before")).alias("body_before"),
            body(F.col("text_after")).alias("body_after"),
            ce.normal_header(_text_header(F.col("header"), F.col("grid"))).alias("head"),
            F.get("numbers", F.lit(0)).alias("first_sr"),
            F.get("numbers", F.size("numbers") - 1).alias("last_sr"),
            "header",
            "grid",
            "repeats",
            "suspect_sr",
            F.coalesce(ce.row_sr(F.get(F.filter(later, lambda r: ~ce.is_marker_row(r)), F.lit(0))).isNotNull(), F.lit(False)).alias("starts_numbered"),
        ).alias("t"),
    )
    keys = ["gazette_id", "span_id"]
    spans = described.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in ("notification_no", "page_start", "page_end", "variant_hint")], F.array_sort(F.collect_list("t")).alias("ts")
    )
    narrow = F.transform("ts", lambda t: F.struct(*[t[c].alias(c) for c in ("page_no", "n_cols", "body_before", "body_after", "head", "first_sr", "last_sr")]))
    chained = spans.withColumn("chain", _chain_ids(cfg.header_ratio)(narrow))
    split = chained.select("*", F.explode(F.array_distinct("chain")).alias("chain_id"))
    # the tables of a chain stand together
    own = F.slice("ts", F.array_position("chain", F.col("chain_id")).cast("int"), F.size(F.filter("chain", lambda c: c == F.col("chain_id"))))
    one = split.select(*keys, "notification_no", "page_start", "page_end", "variant_hint", "chain_id", own.alias("own"))
    rows = F.flatten(F.transform("own", lambda t, i: F.when(i == 0, t["grid"]).otherwise(body_grid(t))))

    def suspects(t: Column, i: Column) -> Column:
        before = F.filter(F.transform(F.slice("own", F.lit(1), i), lambda p: p["last_sr"]), lambda n: n.isNotNull())
        prev = F.get(before, F.size(before) - 1)
        swallowed = (i > 0) & (F.size(t["suspect_sr"]) > 0) & t["starts_numbered"] & prev.isNotNull()
        return F.when(swallowed, F.concat(t["suspect_sr"], F.array(prev))).otherwise(t["suspect_sr"])

    done = one.select(
        *keys,
        "notification_no",
        "page_start",
        "page_end",
        "variant_hint",
        F.col("chain_id").alias("table_seq"),
        F.get("own", F.lit(0))["header"].alias("header"),
        rows.alias("rows"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("own", suspects)))).alias("suspect_sr"),
    )
    # behind a generator: pushed below the projection, the filter would stitch once more
    return done.select(*[c for c in done.columns if c not in ("rows", "suspect_sr")], F.explode(F.array(F.struct("rows", "suspect_sr"))).alias("_t")).where(
        F.size("_t.rows") > 0
    ).select(*[F.col(f"_t.{c}").alias(c) if c in ("rows", "suspect_sr") else c for c in done.columns])


def split_header(stitched: DataFrame) -> DataFrame:
    """``header`` becomes the heading row (blank if there is none) and ``rows`` the data rows."""
    named = F.col("header").isNotNull() & (F.size("header") > 0) & ~ce.is_column_number_row(F.col("header"))
    # a table with a header of its own is not searched for one
    at = F.when(F.coalesce(named, F.lit(False)), 0).otherwise(F.array_position(F.transform(F.slice("rows", 1, 6), lambda r: ce.is_text_header_row(r)), True).cast("int"))
    width = F.aggregate("rows", F.lit(0), lambda w, r: F.greatest(w, F.size(r)))
    found = stitched.withColumns({"named": F.coalesce(named, F.lit(False)), "at": at})
    return found.withColumns(
        {
            "header": F.when(F.col("named"), F.col("header"))
            .when(F.col("at") > 0, F.get("rows", F.col("at") - 1))
            .otherwise(F.array_repeat(F.lit(""), width)),
            "rows": F.when(F.col("named") | (F.col("at") == 0), F.col("rows")).otherwise(F.slice("rows", F.col("at") + 1, F.size("rows"))),
        }
    ).drop("named", "at")


def sample_rows(rows: Column, n: int = 3) -> Column:
    return F.slice(F.filter(rows, lambda r: ~ce.is_marker_row(r)), 1, n)


def neighbour_text(items: DataFrame) -> DataFrame:
    """Texts around tables: input ``gazette_id, page_no, pos, kind ('text' or 'table'), text``;
    per table ``text_before`` and ``text_after`` up to the next table or the page's edge."""
    from pyspark.sql import Window

    page = Window.partitionBy("gazette_id", "page_no")
    upto = page.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    marked = items.withColumn("island", F.sum((F.col("kind") == "table").cast("int")).over(upto))
    texts = marked.where((F.col("kind") == "text") & ~tx.blank(F.col("text")))
    runs = texts.groupBy("gazette_id", "page_no", "island").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias("texts"))
    tables = marked.where(F.col("kind") == "table").select("gazette_id", "page_no", "pos", "island")
    after = runs.withColumnRenamed("texts", "text_after")
    before = runs.select("gazette_id", "page_no", (F.col("island") + 1).alias("island"), F.col("texts").alias("text_before"))
    none = F.array().cast("array<string>")
    keys = ["gazette_id", "page_no", "island"]
    return tables.join(before, keys, "left").join(after, keys, "left").select(
        "gazette_id", "page_no", "pos", F.coalesce("text_before", none).alias("text_before"), F.coalesce("text_after", none).alias("text_after")
    )
