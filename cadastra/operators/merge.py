"""Continuation rows: rows that OCR or a page break cut off the record above them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import cells as ce
from cadastra.functions.text import strip

TABLE = ("gazette_id", "span_id", "table_seq")


def _runs_of(sr: list, filled: list, content: list) -> list[tuple[int, int, bool]]:
    """First row, number of rows and doubt of each record of one table."""
    n = len(sr)
    if None not in sr and not any(content):
        return [(i, 1, False) for i in range(n)]
    upto, lo, last, count = [], [], None, 0
    for i in range(n):
        lo.append(last)
        count += filled[i]
        upto.append(count)
        last = i if sr[i] is not None else last
    hi = last = None
    continues, clash = [False] * n, [False] * n
    for i in range(n - 1, -1, -1):
        hi, last, a = last, i if sr[i] is not None else last, lo[i]
        by = content[i] and i > 0
        verdict = by
        # only the closing anchor itself is filled
        if sr[i] is None and a is not None and hi is not None and upto[hi] - upto[a] == 1 and sr[hi] > sr[a]:
            if sr[hi] == sr[a] + 1:
                verdict = True
            elif sr[hi] - sr[a] - 1 == hi - a - 1:
                verdict = False
        continues[i], clash[i] = verdict, verdict != by
    runs = []
    for i in range(n):
        if not continues[i]:
            # a clash disputes the record above; if the row starts a record, that one as well
            if clash[i] and runs:
                runs[-1][2] = True
            runs.append([i, 1, clash[i]])
        else:
            runs[-1][1] += 1
            runs[-1][2] = runs[-1][2] or clash[i]
    return [tuple(r) for r in runs]


def _runs():
    kind = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("disputed", pa.bool_())]))

    @F.arrow_udf("array<struct<start:int,size:int,disputed:boolean>>")
    def run(sr: pa.Array, filled: pa.Array, content: pa.Array) -> pa.Array:
        parts = [x.flatten().to_pylist() for x in (sr, filled, content)]
        known = sr.is_valid().to_pylist()
        ends, starts, sizes, doubts, at = [0], [], [], [], 0
        for n, ok in zip(sr.value_lengths().to_pylist(), known, strict=True):
            if ok:
                for s, m, d in _runs_of(*(x[at : at + n] for x in parts)):
                    starts.append(s)
                    sizes.append(m)
                    doubts.append(d)
                at += n
            ends.append(len(starts))
        values = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(doubts, pa.bool_())], fields=list(kind.value_type))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, type=kind, mask=None if all(known) else pa.array([not k for k in known]))

    return run


def record_runs(rows: Column, sr_col: Column, survey_col: Column, place_col: Column) -> Column:
    """The records of a table (array of rows in order) as an array of ``start, size, disputed``.

    The position columns are null if unmapped.  Between two numbered rows N and M without an unreadable
    number in between, M = N+1 makes all rows between them continuations, and M-N-1 rows between them
    make each a record whose number was lost.  Otherwise the row's cells decide.  Where the two disagree
    the record above, and the new one if there is one, are disputed."""
    own = lambda r: survey_col.isNotNull() & place_col.isNotNull() & (ce.cell(r, survey_col) != "") & (ce.cell(r, place_col) != "")

    sr_cell = lambda r: ce.cell(r, sr_col)
    numbers = F.transform(rows, lambda r: F.when(sr_col.isNotNull(), ce.parse_sr(sr_cell(r))))
    filled = F.transform(rows, lambda r: (sr_cell(r) != "").cast("int"))
    content = F.transform(rows, lambda r: F.coalesce((sr_col < F.size(r)) & (sr_cell(r) == "") & ~own(r), F.lit(False)))
    return _runs()(numbers, filled, content)


def _joined(parts: Column) -> Column:
    """Rows joined column by column, blanks left out."""
    one = lambda rows: F.transform(F.get(rows, F.lit(0)), lambda c: F.coalesce(strip(c), F.lit("")))
    width = F.array_max(F.transform(parts, F.size))
    column = lambda i: F.array_join(F.filter(F.transform(parts, lambda p: ce.cell(p, i)), lambda c: c != ""), " ")
    many = F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), column)).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(parts) == 1, one(parts)).otherwise(many)


def fold_tables(tables: DataFrame, sr_col: Column, survey_col: Column, place_col: Column) -> DataFrame:
    """One row per record of each table: ``record_id``, ``cells`` and ``disputed`` take the place of
    ``rows`` (array of rows in order), all other columns stay.  Nothing is shuffled or sorted."""
    others = [c for c in tables.columns if c != "rows"]
    found = tables.withColumn("_runs", record_runs(F.col("rows"), sr_col, survey_col, place_col))
    records = F.transform("_runs", lambda r: F.struct(F.slice("rows", r["start"] + 1, r["size"]).alias("parts"), r["disputed"].alias("disputed")))
    each = found.select(*others, F.posexplode(records).alias("record_id", "_r"))
    # joined after the explosion, and behind a generator of its own so that filters on the cells do not join once more
    cells = each.select(*others, F.col("record_id").cast("bigint").alias("record_id"), "_r.disputed", F.explode(F.array(_joined(F.col("_r.parts")))).alias("cells"))
    return cells.select(*others, "record_id", "cells", "disputed")


def number_records(rows: DataFrame, keys: tuple[str, ...] = TABLE) -> DataFrame:
    """Adds ``continues``, ``record_id`` and ``disputed`` (rules of ``record_runs``) to rows in ``row_idx`` order.

    Input columns: ``cells`` and the position columns ``sr_col``, ``survey_col``, ``place_col``, equal in all rows of a table."""
    others = [c for c in rows.columns if c not in keys]
    tables = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("row_idx", *[c for c in others if c != "row_idx"]))).alias("_rows"))
    top = F.get("_rows", F.lit(0))
    found = tables.withColumn("_runs", record_runs(F.transform("_rows", lambda r: r["cells"]), top["sr_col"], top["survey_col"], top["place_col"]))
    records = F.transform("_runs", lambda r: F.struct(F.slice("_rows", r["start"] + 1, r["size"]).alias("parts"), r["disputed"].alias("disputed")))
    each = found.select(*keys, F.posexplode(records).alias("record_id", "_r"))
    listed = each.select(*keys, F.col("record_id").cast("bigint").alias("record_id"), "_r.disputed", F.posexplode("_r.parts").alias("_at", "_row"))
    return listed.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns], (F.col("_at") > 0).alias("continues"), "record_id", "disputed")


def fold_records(numbered: DataFrame, keys: tuple[str, ...] = TABLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per record: ``cells`` joined column by column, blanks left out, in row order.
    ``carry`` names columns that are equal in all rows of a table; they go with its records."""
    grouped = numbered.groupBy(*keys, "record_id").agg(
        F.array_sort(F.collect_list(F.struct("row_idx", "cells"))).alias("parts"), F.max("disputed").alias("disputed"), *[F.first(c).alias(c) for c in carry]
    )
    return grouped.select(*keys, "record_id", _joined(F.transform("parts", lambda p: p["cells"])).alias("cells"), "disputed", *carry)


def apply_column_map(cells: Column, column_map: Column, fields: tuple[str, ...]) -> Column:
    """Struct of fields; null where the field is unmapped or the row too short."""
    return F.struct(*[strip(F.get(cells, column_map[f])).alias(f) for f in fields])
