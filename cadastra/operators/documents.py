"""Whole-document operators: Markdown assembly, chunking, scan thresholds, timings."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_marker(page_no: Column) -> Column:
    return F.concat(F.lit("[Page "), page_no.cast("string"), F.lit("]"))


def to_markdown(pages: DataFrame, id_col: str = "gazette_id") -> DataFrame:
    """One Markdown text per document: pages in order, each under its marker, parted by rules.
    Rows without a page number are a document without pages: their texts stand alone."""
    body = F.coalesce("text", F.lit(""))
    section = F.regexp_replace(F.when(F.col("page_no").isNull(), body).otherwise(F.concat(page_marker(F.col("page_no")), F.lit("\n\n"), body)), r"(?U)\s+$", "")
    grouped = pages.select(id_col, "page_no", section.alias("section")).groupBy(id_col).agg(
        F.count("page_no").alias("n_pages"), F.array_sort(F.collect_list(F.struct("page_no", "section"))).alias("s")
    )
    joined = F.array_join(F.transform("s", lambda x: x["section"]), "\n\n---\n\n")
    return grouped.select(id_col, F.when(F.col("n_pages") > 0, F.concat(joined, F.lit("\n"))).otherwise(joined).alias("markdown"))


def count_words(text: str) -> int:
    return len(text.split())


def chunk(blocks: DataFrame, max_tokens: int = 512, counter: Callable[[str], int] = count_words, id_col: str = "gazette_id") -> DataFrame:
    """Greedy chunks of at most ``max_tokens`` tokens that never cross a heading.

    Input: ``id, pos, page_no, heading, text``; output: id, ``chunk_no``, ``text``, ``embed_text``
    (headings above the text), ``pages`` (sorted, distinct), ``headings``.  A block that is too long
    is cut at words.  One document is one group: a document fits a task."""
    kind = dict(blocks.dtypes)[id_col]

    def pieces(text: str):
        words = text.split()
        start = 0
        while start < len(words):
            lo, hi = 1, len(words) - start
            while lo < hi:  # longest run that still fits; one word is always taken
                mid = (lo + hi + 1) // 2
                lo, hi = (mid, hi) if counter(" ".join(words[start : start + mid])) <= max_tokens else (lo, mid - 1)
            yield " ".join(words[start : start + lo])
            start += lo

    def run(doc: pd.DataFrame) -> pd.DataFrame:
        out, held, pages, heading = [], [], set(), None

        def close() -> None:
            if held:
                text = "\n".join(held)
                heads = [heading] if heading else []
                out.append((len(out), text, "\n".join([*heads, text]), sorted(pages), heads))
            held.clear()
            pages.clear()

        for head, page, text in zip(*(doc.sort_values("pos")[c] for c in ("heading", "page_no", "text")), strict=True):
            head = head if isinstance(head, str) and head else None
            if head != heading:
                close()
                heading = head
            for part in [text] if isinstance(text, str) and text.strip() and counter(text) <= max_tokens else pieces(text if isinstance(text, str) else ""):
                if held and counter("\n".join([*held, part])) > max_tokens:
                    close()
                held.append(part)
                if not pd.isna(page):
                    pages.add(int(page))
        close()
        frame = pd.DataFrame(out, columns=["chunk_no", "text", "embed_text", "pages", "headings"])
        frame.insert(0, id_col, doc[id_col].iloc[0])
        return frame

    schema = f"{id_col} {kind}, chunk_no int, text string, embed_text string, pages array<int>, headings array<string>"
    return blocks.select(id_col, "pos", "page_no", "heading", "text").groupBy(id_col).applyInPandas(run, schema)


def otsu_threshold(pixels: DataFrame, id_col: str = "page_id", value_col: str = "value") -> DataFrame:
    """Grey level that best parts dark from light (0..255), by page: histogram, running sums, argmax."""
    hist = pixels.groupBy(id_col, F.col(value_col).alias("v")).agg(F.count("*").alias("n"))
    upto, of = Window.partitionBy(id_col).orderBy("v"), Window.partitionBy(id_col)
    sums = hist.select(
        id_col, "v", F.sum("n").over(upto).alias("w0"), F.sum(F.col("n") * F.col("v")).over(upto).alias("s0"), F.sum("n").over(of).alias("w"), F.sum(F.col("n") * F.col("v")).over(of).alias("s")
    )
    w1 = F.col("w") - F.col("w0")
    apart = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / F.nullif(w1, F.lit(0))
    scored = sums.withColumn("between", F.coalesce(F.col("w0") * w1 * apart * apart, F.lit(0.0)))
    return scored.groupBy(id_col).agg(F.min(F.struct((-F.col("between")).alias("b"), "v")).alias("x")).select(id_col, F.col("x.v").alias("threshold"))


def timing_stats(timings: DataFrame) -> DataFrame:
    """``stage``, ``count``, ``total_s``, ``avg_s`` of rows (stage, seconds)."""
    return timings.groupBy("stage").agg(F.count("*").alias("count"), F.sum("seconds").alias("total_s"), F.avg("seconds").alias("avg_s"))
