"""Column functions on page text: stripping, pattern sets, prose, page furniture."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: an expression that names a column several times
    would otherwise be copied into the plan as often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: The characters of the pattern ``(?U)\\s``.
WHITE = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    """Remove all Unicode white space at both ends (``trim`` only removes U+0020).  A list of
    characters, not a pattern: a pattern tries every place of a text for its end."""
    return F.btrim(c, F.lit(WHITE))


def squash(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """First match or null (``regexp_extract`` answers '' for no match)."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def any_pattern(patterns: Sequence[str]) -> str:
    """One alternation of all patterns, case ignored."""
    return "(?i)(?:" + "|".join(f"(?:{p})" for p in patterns) + ")" if patterns else r"(?!)"


def matches_any(c: Column, patterns: Sequence[str]) -> Column:
    return c.rlike(any_pattern(patterns))


def prose(text: Column) -> Column:
    """Page text without the lines of Markdown tables, so that cells cannot match an anchor."""
    lines = F.filter(F.split(text, r"\R"), lambda line: ~line.rlike(r"(?U)^\s*\|"))
    return F.array_join(lines, "\n")


def notification_no(text: Column) -> Column:
    return F.nullif(strip(extract(text, r"(?i)Notification\s+No\.?\s*([^\r\n]+)")), F.lit(""))


def variant_hint(text: Column) -> Column:
    return F.when(text.rlike("(?i)No Development Zone"), "ndz").when(text.rlike(r"(?i)change of zone|Section\s+39A"), "change_of_zone")


def is_running_text(c: Column, patterns: Sequence[str], longest: int = 80) -> Column:
    t = strip(c)
    return (F.length(t) <= longest) & matches_any(t, patterns)


def body_text(texts: Column, patterns: Sequence[str], longest: int = 80) -> Column:
    """Elements that are neither blank nor page furniture; null counts as none."""
    return F.filter(F.coalesce(texts, F.array().cast("array<string>")), lambda t: ~blank(t) & ~is_running_text(t, patterns, longest))


def page_class(text: Column, below: int = 50) -> Column:
    return F.when(F.length(strip(F.coalesce(text, F.lit("")))) < below, "scanned").otherwise("digital")
