"""Column functions on table rows (``array<string>``): header, marker and number rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra.functions.text import blank, extract, let, strip

_NUMBER_CELL = r"^\(?(\d{1,2})\)?\.?$"
_NUMBERS = r"(?U)^\s*(?:\(?[0-9]{1,2}\)?\.?\s+){2,}\(?[0-9]{1,2}\)?\.?\s*$"


def is_column_number_row(row: Column) -> Column:
    """Rows that number the columns: at least three numbers, strictly rising."""
    number = lambda t: F.regexp_extract(t, _NUMBER_CELL, 1).try_cast("int")

    def rises(joined: Column) -> Column:
        # one pass: the last number while rising, then -2 for good
        words = F.filter(F.split(joined, r"(?U)\s+"), lambda w: w != "")
        last = F.aggregate(words, F.lit(-1), lambda last, t: F.when((last > -2) & (number(t) > last), number(t)).otherwise(-2))
        return last >= 0

    # the pattern turns away nearly all rows at their first words; only rows of numbers alone are walked
    joined = F.array_join(row, " ", "")
    return F.coalesce(let(joined, lambda j: F.when(j.rlike(_NUMBERS), rises(j))), F.lit(False))


def is_text_header_row(row: Column) -> Column:
    joined = F.lower(F.array_join(F.filter(F.transform(row, lambda c: strip(F.coalesce(c, F.lit("")))), lambda c: c != ""), " "))
    named = lambda j: j.contains("applicant") | j.contains("sy") | j.contains("survey") | j.contains("no development")
    return F.coalesce(let(joined, lambda j: j.contains("sr") & named(j)), F.lit(False))


def is_header_like(row: Column) -> Column:
    return is_column_number_row(row) | is_text_header_row(row)


def is_marker_row(row: Column) -> Column:
    """Blank rows and rows that number the columns."""
    return F.forall(row, blank) | is_column_number_row(row)


def parse_sr(cell: Column) -> Column:
    """Serial number at the start of a table cell."""
    return extract(F.coalesce(cell, F.lit("")), r"^\s*(\d{1,3})\s*[.)]?(?:\s|$)").try_cast("int")


def row_sr(row: Column) -> Column:
    return F.when(~is_column_number_row(row), parse_sr(F.get(row, F.lit(0))))


def cell(row: Column, at: Column) -> Column:
    """Stripped cell, or '' without such a column."""
    return F.coalesce(strip(F.get(row, at)), F.lit(""))


def folds_first_column(header: Column) -> Column:
    """Whether the header's numbers show that columns 1 and 2 were read as one."""
    head = F.filter(F.transform(F.split(F.get(header, F.lit(0)), r"(?U)\s+"), lambda t: F.regexp_extract(t, _NUMBER_CELL, 1)), lambda t: t != "")
    return F.coalesce(is_column_number_row(header) & F.array_join(head, " ").isin("1 2", "2"), F.lit(False))


def normal_header(row: Column) -> Column:
    return strip(F.regexp_replace(F.lower(F.array_join(row, " ")), r"(?U)\s+", " "))
