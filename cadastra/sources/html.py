"""Any-file source for the formats that need no external parser: HTML, Markdown and plain text."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_HEADINGS = {f"h{i}": "#" * i + " " for i in range(1, 7)}
_BLOCK = {"p", "div", "section", "article", "ul", "ol", "table", "blockquote", "pre", "header", "footer", "main", "nav", "body"}
_SILENT = {"script", "style", "head", "noscript", "template"}


class _Writer(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.line: list[str] = []
        self.prefix, self.silent, self.row = "", 0, None

    def flush(self) -> None:
        text = " ".join("".join(self.line).split())
        if text:
            self.blocks.append(self.prefix + text)
        self.line, self.prefix = [], ""

    def handle_starttag(self, tag, attrs):
        if tag in _SILENT:
            self.silent += 1
        elif tag == "tr":
            self.flush()
            self.row = []
        elif tag in _HEADINGS or tag == "li" or tag in _BLOCK:
            self.flush()
            self.prefix = _HEADINGS.get(tag, "- " if tag == "li" else "")
        elif tag == "br":
            self.line.append(" ")

    def handle_endtag(self, tag):
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in ("td", "th") and self.row is not None:
            self.row.append(" ".join("".join(self.line).split()))
            self.line = []
        elif tag == "tr" and self.row is not None:
            self.blocks.append("| " + " | ".join(self.row) + " |")
            self.row = None
        elif tag in _HEADINGS or tag == "li" or tag in _BLOCK:
            self.flush()

    def handle_data(self, data):
        if not self.silent:
            self.line.append(data)


def html_to_markdown(text: str) -> str:
    w = _Writer()
    w.feed(text)
    w.close()
    w.flush()
    return "\n\n".join(w.blocks)


def markdown_column(c: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else html_to_markdown(x))

    return run(c)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """``path, page_no (null), text`` of HTML, Markdown or text files; other formats need a parser
    plug-in that yields page rows."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    is_html = F.lower("path").rlike(r"\.html?$")
    marked = files.where(is_html).withColumn("text", markdown_column(F.col("text")))
    plain = files.where(F.lower("path").rlike(r"\.(md|txt)$"))
    return marked.unionByName(plain).select("path", F.lit(None).cast("int").alias("page_no"), "text")
