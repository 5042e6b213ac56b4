"""The extraction plan: page texts and raw tables of many gazettes to application rows and plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.config import EngineConfig
from cadastra.functions import cells as ce
from cadastra.operators import gazette, mapping, merge, records, spans, tables


def extract_rows(meta: DataFrame, pages: DataFrame, raw_tables: DataFrame, cfg: EngineConfig = EngineConfig(), transport=None) -> DataFrame:
    """Application rows of all gazettes.  Every key begins with ``gazette_id``: gazettes never mix.

    Without a model all steps up to the records are one (``gazette``); with one, they are those of the
    single operators, which give the same records and the samples to ask about."""
    found = records_at_once(meta, pages, raw_tables, cfg) if transport is None else stepwise(meta, pages, raw_tables, cfg, transport)
    return records.application_rows(found)


def records_at_once(meta: DataFrame, pages: DataFrame, raw_tables: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """The records of all gazettes, from one pass over each."""
    found = gazette.find_records(meta, pages, raw_tables, cfg)
    table = [F.col(f"_t.{c}").alias(c) for c in ("span_id", "table_seq", "notification_no", "page_start", "page_end", "variant", "confidence", "suspect_sr")]
    return found.select("gazette_id", "source_filename", *table, F.explode("_t.records").alias("_r")).select("*", "_r.*").drop("_r")


def stepwise(meta: DataFrame, pages: DataFrame, raw_tables: DataFrame, cfg: EngineConfig = EngineConfig(), transport=None) -> DataFrame:
    """The records of all gazettes, operator after operator."""
    found = spans.find_spans(pages, raw_tables, cfg)
    stitched = tables.split_header(tables.stitch(spans.tables_in_spans(raw_tables, found), cfg))
    mapped = mapping.map_columns(stitched, transport)
    names = meta.select("gazette_id", "source_filename")
    keys = ["gazette_id", "span_id", "table_seq"]
    # tables that are none of ours lose their rows here: a filter on the verdict or on the rows would
    # be pushed below the projections and compute stitching and mapping once more
    wanted = F.filter(F.when(F.col("mapped.is_39a"), F.col("rows")), lambda r: ~ce.is_marker_row(r))
    described = mapped.select(
        *keys, "notification_no", "page_start", "page_end", "suspect_sr", "header", "mapped.column_map", "mapped.variant", "mapped.confidence", wanted.alias("rows")
    )
    at = F.col("column_map")
    merged = merge.fold_tables(described, at["sr_no"], at["survey"], at["village_taluka"])
    back = merged.where(~ce.is_marker_row(F.col("cells")))
    return back.withColumns(
        {
            "raw": merge.apply_column_map(F.col("cells"), F.col("column_map"), schemas.FIELDS),
            "variant": F.coalesce("variant", mapping.infer_variant(F.col("header"))),
        }
    ).join(names, "gazette_id", "left")


def extract(meta: DataFrame, pages: DataFrame, raw_tables: DataFrame, cfg: EngineConfig = EngineConfig(), transport=None) -> dict[str, DataFrame]:
    """``rows`` (all), ``good``, ``issues`` and ``plots`` (of good rows)."""
    rows = extract_rows(meta, pages, raw_tables, cfg, transport)
    good, issues = records.validate(rows)
    return {"rows": rows, "good": good, "issues": issues, "plots": records.plots(good)}
