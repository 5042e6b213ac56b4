"""Scalar parsers as column functions: numbers, areas, places, surveys, hashes, file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.functions.text import extract, let, squash, strip


def indian_int(text: Column) -> Column:
    """First run of digits and commas once spaces are gone; null if it holds no digit."""
    run = F.regexp_extract(F.replace(text, F.lit(" "), F.lit("")), r"([0-9,]+)", 1)
    return F.replace(run, F.lit(","), F.lit("")).try_cast("bigint")


def total_area(text: Column) -> Column:
    """The number in ``Total Area (...)`` if that is there, else the first number."""
    inner = extract(text, r"(?i)Total\s+Area\s*\(([^)]+)\)")
    return F.when(inner.isNotNull(), indian_int(inner)).otherwise(indian_int(text))


def area_breakdown(text: Column) -> Column:
    """``Partly <use> (<n>m2)`` as an array of use and sqm."""
    pattern = F.lit(r"(?i)Partly\s+([^(\[]+?)\s*\((\d+)m2\)")
    text = F.coalesce(text, F.lit(""))
    both = F.arrays_zip(F.regexp_extract_all(text, pattern, 1).alias("u"), F.regexp_extract_all(text, pattern, 2).alias("n"))
    return F.transform(both, lambda x: F.struct(strip(x["u"]).alias("use"), x["n"].try_cast("bigint").alias("sqm")))


def is_known_taluka(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)).isin(*schemas.TALUKAS), F.lit(False))


def split_place(value: Column) -> Column:
    """``village`` and ``taluka`` of a comma list; a single name is a taluka only if it is known."""

    def named(parts: Column) -> Column:
        first, last, many = F.get(parts, F.lit(0)), F.get(parts, F.size(parts) - 1), F.size(parts) > 1
        known = is_known_taluka(first)
        return F.struct(F.when(many | ~known, first).alias("village"), F.when(many, last).when(known, first).alias("taluka"))

    return let(F.filter(F.transform(F.split(value, ","), strip), lambda p: p != ""), named)


# Forms of survey numbers.
_RANGE = r"(?i)(\d+)/(\d+)\s+to\s+(\d+)(?:\s*\((P|Part)\))?"
#: A text that is one range and nothing else: read with string functions, as nearly all texts with ranges are.
_ONE_RANGE = r"^\d{1,38}/\d{1,38} to \d{1,38}$"
_SINGLE = r"(?i)^(\d+)/(\d+(?:-[A-Za-z0-9]+)?)(?:\s*\((P|Part)\))?"
_PLOT = r"(?i)Plot\s+No\.?\s*([A-Za-z0-9\-]+)"
_SPAN = "struct<prefix:string,lo:decimal(38,0),hi:decimal(38,0),number:string,is_part:boolean>"


def survey_spans(raw: Column) -> Column:
    """Survey numbers as an array of spans in order of mention: ranges first (``prefix``, ``lo``,
    ``hi``; a range counts up only), then single tokens (``number``).  A range stays two numbers here,
    however long it is.  Bounds of more than 38 digits give no span."""
    text = F.replace(F.coalesce(raw, F.lit("")), F.lit("\n"), F.lit(" "))
    group = [F.regexp_extract_all(text, F.lit(_RANGE), g) for g in (1, 2, 3, 4)]
    none = F.lit(None).cast("decimal(38,0)")

    def span(x: Column) -> Column:
        return F.struct(
            x["0"].alias("prefix"), x["1"].try_cast("decimal(38,0)").alias("lo"), x["2"].try_cast("decimal(38,0)").alias("hi"),
            F.lit(None).cast("string").alias("number"), (x["3"] != "").alias("is_part"),
        )

    ranges = F.filter(F.transform(F.arrays_zip(*group), span), lambda s: s["lo"] <= s["hi"])
    tokens = F.transform(F.split(F.regexp_replace(text, _RANGE, ""), ","), lambda t: squash(strip(t)))

    def single(t: Column) -> Column:
        number = F.concat(F.regexp_extract(t, _SINGLE, 1), F.lit("/"), F.regexp_extract(t, _SINGLE, 2))
        plot = F.concat(F.lit("Plot No. "), F.regexp_extract(t, _PLOT, 1))
        one = lambda n, part: F.struct(F.lit(None).cast("string").alias("prefix"), none.alias("lo"), none.alias("hi"), n.alias("number"), part.alias("is_part"))
        return F.when(t.rlike(_SINGLE), one(number, F.regexp_extract(t, _SINGLE, 3) != "")).when(t.rlike(_PLOT), one(plot, F.lit(False)))

    singles = F.filter(F.transform(F.filter(tokens, lambda t: ~t.isin("", "(P)", "(Part)")), single), lambda e: e.isNotNull())
    none_found = F.array().cast(f"array<{_SPAN}>")
    bounds = F.substring_index(raw, "/", -1)
    lo, hi = (F.substring_index(bounds, " ", n).try_cast("decimal(38,0)") for n in (1, -1))
    own = F.struct(F.substring_index(raw, "/", 1).alias("prefix"), lo.alias("lo"), hi.alias("hi"), F.lit(None).cast("string").alias("number"), F.lit(False).alias("is_part"))
    # $ also stands before a last line break, which is no digit
    alone = raw.rlike(_ONE_RANGE) & F.right(raw, F.lit(1)).between("0", "9")
    return F.when(raw.isNull(), none_found).when(alone, F.when(lo <= hi, F.array(own)).otherwise(none_found)).otherwise(F.concat(ranges, singles))


#: Numbers of a range that one row carries before they are listed one by one.
RANGE_BLOCK = 4096


def explode_surveys(df: DataFrame, raw: Column) -> DataFrame:
    """One row per survey number of each row: the columns of ``df`` with ``survey_number`` and
    ``is_part``; the first mention of a number wins.  Ranges of any length are listed in blocks, so no
    row holds all numbers of one."""
    own = [F.col(f"`{c}`") for c in df.columns]
    spans = df.select(*own, survey_spans(raw).alias("_spans"))
    each = spans.select(*own, "_spans", F.posexplode("_spans").alias("_at", "_s"))
    before = F.slice("_spans", 1, F.col("_at"))
    s = F.col("_s")
    # of the spans before, only those that could hold one of this span's numbers
    key = F.coalesce(s["prefix"], F.substring_index(s["number"], "/", 1))
    rivals = F.when(F.col("_at") == 0, F.array().cast(f"array<{_SPAN}>")).otherwise(F.filter(before, lambda b: (b["number"] == s["number"]) | (b["prefix"] == key)))
    last = F.coalesce((s["hi"] - s["lo"]).try_cast("bigint"), F.lit(0))
    each = each.select(*own, "_s", rivals.alias("_rivals"), last.alias("_last"))
    blocks = each.select(*own, "_s", "_rivals", "_last", F.explode(F.expr(f"sequence(0L, _last div {RANGE_BLOCK}L)")).alias("_block"))
    first = F.col("_block") * RANGE_BLOCK
    listed = blocks.select(*own, "_s", "_rivals", F.explode(F.sequence(first, F.least(first + (RANGE_BLOCK - 1), F.col("_last")))).alias("_k"))
    number = F.coalesce(s["number"], F.concat(s["prefix"], F.lit("/"), (s["lo"] + F.col("_k")).cast("decimal(38,0)").cast("string")))
    named = listed.select(*own, number.alias("survey_number"), s["is_part"].alias("is_part"), "_rivals")
    tail = F.substring_index("survey_number", "/", -1)
    value = F.when(tail.rlike(r"^(0|[1-9]\d*)$"), tail.try_cast("decimal(38,0)"))
    said = F.exists("_rivals", lambda b: F.coalesce((b["number"] == F.col("survey_number")) | value.between(b["lo"], b["hi"]), F.lit(False)))
    return named.where((F.size("_rivals") == 0) | ~said).drop("_rivals")


def validation_sr(sr_no: Column) -> Column:
    """First number anywhere in the serial number (not the rule of table cells)."""
    return extract(F.coalesce(sr_no, F.lit("")), r"(\d+)").try_cast("bigint")


def row_hash(gazette_id: Column, notification_no: Column, sr_no: Column, survey: Column, decision: Column) -> Column:
    """SHA-256 over the key parts; a missing part is empty."""
    parts = [F.coalesce(c, F.lit("")) for c in (gazette_id, notification_no, sr_no, survey, decision)]
    return F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)


def plot_hash(gazette_id: Column, notification_no: Column, sr_no: Column, survey_number: Column) -> Column:
    """SHA-256 over the key parts; here a missing part reads ``None``."""
    parts = [F.coalesce(c, F.lit("None")) for c in (gazette_id, notification_no, sr_no, survey_number)]
    return F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)


def slugify(text: Column, longest: int = 80) -> Column:
    slug = F.regexp_replace(strip(text), "[^a-zA-Z0-9._-]+", "_")
    slug = F.regexp_replace(F.regexp_replace(slug, "_+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(slug, 1, longest), F.lit("")), F.lit("gazette"))


def gazette_id(stem: Column, sha256: Column) -> Column:
    return F.concat(slugify(stem), F.lit("_"), F.substring(sha256, 1, 12))


def filename_meta(name: Column) -> Column:
    """``series``, ``issue_no`` and ``gazette_date`` as text (a day with a month's name stays as
    year-month-day text)."""
    issue = extract(name, r"(?i)SIII[-_]?OG(\d+)")
    words = r"(\d{1,2})(?:st|nd|rd|th)?\s+([A-Za-z]+)\s+(\d{4})"
    spoken = F.concat_ws("-", *[F.regexp_extract(name, words, g) for g in (3, 2, 1)])
    return F.struct(
        F.when(issue.isNotNull(), "SIII").alias("series"),
        issue.alias("issue_no"),
        F.coalesce(extract(name, r"(\d{4}-\d{2}-\d{2})"), F.when(name.rlike(words), spoken)).alias("gazette_date"),
    )
