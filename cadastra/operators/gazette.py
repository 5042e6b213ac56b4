"""Records of whole gazettes in one pass over their cells.

The rules are those of ``spans``, ``tables``, ``mapping`` and ``merge``, whose column expressions
walk every cell a dozen times.  Here the cells of a batch of gazettes stand in one list, tables and
rows are places in it, and a cell is looked at only where a rule depends on it.  Flags of page and
neighbour texts are still computed in columns."""

from __future__ import annotations

import gc
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.config import EngineConfig
from cadastra.functions.text import WHITE
from cadastra.operators import mapping, merge, spans, tables

_W = f"[{re.escape(WHITE)}]"
_SPACES = re.compile(f"{_W}+")
# Java's ``\s`` and ``$``: ASCII white space; the end or the place before a last line terminator
_SR = re.compile(r"[\t-\r ]*([0-9]{1,3})[\t-\r ]*[.)]?(?:[\t-\r ]|(?=[\x85\u2028\u2029]?\Z))")
_INNER_SR = re.compile(rf"{_W}(\d{{1,3}})\.{_W}+(?=\d)")
_NUMBER_CELL = re.compile(r"\(?([0-9]{1,2})\)?\.?\Z")
_NUMBERS = re.compile(rf"{_W}*(?:\(?[0-9]{{1,2}}\)?\.?{_W}+){{2,}}\(?[0-9]{{1,2}}\)?\.?{_W}*\Z")
_NUMBER_ENDS = frozenset("0123456789).")

_RAW = "struct<" + ", ".join(f"{f}: string" for f in schemas.FIELDS) + ">"
_FOUND = (
    "array<struct<span_id: int, table_seq: int, notification_no: string, page_start: int, page_end: int, variant: string, confidence: double,"
    f" suspect_sr: array<int>, records: array<struct<record_id: bigint, disputed: boolean, raw: {_RAW}>>>>"
)


def number_row(row) -> bool:
    """``cells.is_column_number_row`` of stripped cells."""
    last = row[-1] if row else ""
    if last and last[-1] not in _NUMBER_ENDS:
        return False
    joined = " ".join(row)
    if not _NUMBERS.match(joined):
        return False
    numbers = [int(_NUMBER_CELL.match(w)[1]) for w in _SPACES.split(joined.strip(WHITE))]
    return all(a < b for a, b in zip(numbers, numbers[1:], strict=False))


def text_header_row(row) -> bool:
    """``cells.is_text_header_row`` of stripped cells."""
    if "sr" not in " ".join(row).lower():
        return False
    joined = " ".join(c for c in row if c).lower()
    return "applicant" in joined or "sy" in joined or "survey" in joined or "no development" in joined


@lru_cache(maxsize=100_000)
def parse_sr(cell: str) -> int | None:
    found = _SR.match(cell)
    return int(found[1]) if found else None


@lru_cache(maxsize=20_000)
def _heading(header: tuple[str | None, ...]) -> tuple[bool, bool, bool]:
    """Whether a header numbers the columns, shows that columns 1 and 2 were read as one, is blank."""
    cells = [(c or "").strip(WHITE) for c in header]
    numbers = number_row(cells)
    head = [m[1] for w in _SPACES.split(header[0]) if (m := _NUMBER_CELL.match(w))] if numbers and header[0] is not None else []
    return numbers, " ".join(head) in ("1 2", "2"), not any(cells)


@lru_cache(maxsize=20_000)
def _normal(header: tuple[str | None, ...]) -> str:
    return _SPACES.sub(" ", " ".join(c for c in header if c is not None).lower()).strip(WHITE)


def walk(pages: list[tuple]) -> list[list]:
    """Spans of one gazette, as ``spans.walk_spans``: notification, first and last page, hint.  Pages:
    number, anchor, closes, notification, hint, ends_start, ends_any, fresh; in order."""
    done, own = [], None
    for no, anchor, closes, note, hint, ends_start, ends_any, fresh in pages:
        closing = False
        if own is not None:
            # a page without a number neither lies beyond the first page nor does not
            closing = closes and (no is None or own[1] is None or no > own[1] + 1)
            if not closing and not anchor and not ends_any:
                own[2] = no
                continue
            if closing or not anchor:
                own[2] = no
            done.append(own)
        starts = anchor and (own is None or fresh or not closing)
        if starts and ends_start:
            done.append([note, no, no, hint])
        own = [note, no, no, hint] if starts and not ends_start else None
    return done if own is None else [*done, own]


def _values(x: pa.Array) -> list:
    return x.to_pylist() if x.null_count and not pa.types.is_string(x.type) else x.to_numpy(zero_copy_only=False).tolist()


def _starts(x: pa.Array) -> list[int]:
    """Where each list of an array begins among all their values, and the end of the last."""
    return [0, *np.cumsum(pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)).tolist()]


class _Batch:
    """The tables of a batch of gazettes.  ``cells``: all cells, stripped; a row is its first cell's place
    and its length; repaired and joined rows stand behind the cells that were read."""

    def __init__(self, found: pa.Array, ratio: float):
        page, _, n_cols, before, after, header, grid, anchor, fresh = found.flatten()
        self.page, self.before, self.after, self.anchor, self.fresh = map(_values, (page, before, after, anchor, fresh))
        self.n_cols, self.ratio = _values(n_cols), ratio
        names, at = _values(header.flatten()), _starts(header)
        self.header = [tuple(names[a:b]) if ok else None for a, b, ok in zip(at, at[1:], _values(header.is_valid()), strict=False)]
        rows = grid.flatten()
        self.rows_at, self.cells_at = _starts(grid), _starts(rows)
        read = pc.fill_null(rows.flatten(), "")
        self.read = pc.utf8_trim(read, WHITE)
        self.cells = _values(self.read)
        self.n_read = len(self.cells)
        self.unstripped = self.cells if self.read.equals(read) else _values(read)

    def add(self, row: list[str]) -> tuple[int, int]:
        at = len(self.cells)
        self.cells += row
        return at, len(row)

    def row(self, row: tuple[int, int]) -> list[str]:
        return self.cells[row[0] : row[0] + row[1]]

    def marker(self, row: tuple[int, int]) -> bool:
        at, n = row
        if not n:
            return True
        last = self.cells[at + n - 1]
        if last and last[-1] not in _NUMBER_ENDS:
            return False
        cells = self.cells[at : at + n]
        return not any(cells) or number_row(cells)

    def header_like(self, row: tuple[int, int]) -> bool:
        cells = self.row(row)
        return number_row(cells) or text_header_row(cells)

    def row_sr(self, row: tuple[int, int]) -> int | None:
        at, n = row
        if not n:
            return None
        said = parse_sr(self.unstripped[at] if at < self.n_read else self.cells[at])
        if said is None:
            return None
        last = self.cells[at + n - 1]
        return said if last and last[-1] not in _NUMBER_ENDS or not number_row(self.row(row)) else None

    def repaired(self, row: tuple[int, int]) -> list[tuple[int, int]]:
        """A row whose first two columns were read as one (``tables.split_first_column``)."""
        cells = self.row(row)
        if self.marker(row):
            return [self.add(["", *cells])]
        first, rest = cells[0], cells[1:]
        if found := _SR.match(first):
            return [self.add([found[0].strip(WHITE), first[found.end() :].strip(WHITE), *rest])]
        if found := _INNER_SR.search(first):
            above = ["", first[: found.start()].strip(WHITE), *[""] * len(rest)]
            return [self.add(above), self.add([found[1] + ".", first[found.end() :].strip(WHITE), *rest])]
        return [self.add(["", *cells])]

    def table(self, k: int) -> tuple[tuple | None, int, list[tuple[int, int]], list[int]]:
        """Header, number of columns, rows and suspect numbers of a table, its first column repaired."""
        header, n_cols, at = self.header[k], self.n_cols[k] or 0, self.cells_at
        rows = [(at[r], at[r + 1] - at[r]) for r in range(self.rows_at[k], self.rows_at[k + 1])]
        if not header or not _heading(header)[1]:
            return header, n_cols, rows, []
        suspects = [n for r in rows if not self.marker(r) and (n := parse_sr(self.cells[r[0]])) is not None]
        return tuple(map(str, range(1, n_cols + 2))), n_cols + 1, [x for r in rows for x in self.repaired(r)], suspects

    def chains(self, ks: range, fixed: list[tuple]) -> list[int]:
        if len(ks) == 1:
            return [0]
        flags = []
        for k, (header, n_cols, rows, _) in zip(ks, fixed, strict=True):
            head = None
            if header and not any(_heading(header)[::2]):
                head = _normal(header)
            elif rows and text_header_row(top := self.row(rows[0])):
                head = _normal(tuple(top))
            first = next((n for r in rows if (n := self.row_sr(r)) is not None), None)
            flags.append((self.page[k], n_cols, self.before[k], self.after[k], head, first, self.last_sr(rows)))
        return tables.chain_numbers(flags, self.ratio)

    def last_sr(self, rows: list[tuple[int, int]]) -> int | None:
        return next((n for r in reversed(rows) if (n := self.row_sr(r)) is not None), None)

    def stitched(self, ks: range):
        """Number, header, rows and suspects of each logical table of a span (``tables.stitch``)."""
        fixed = [self.table(k) for k in ks]
        chain = self.chains(ks, fixed)
        for seq in range(chain[-1] + 1):
            own = [t for t, c in zip(fixed, chain, strict=True) if c == seq]
            header, _, rows, suspects = own[0]
            prev = self.last_sr(rows) if len(own) > 1 else None
            for _, _, more, marked in own[1:]:
                later = more[1:] if more and self.header_like(more[0]) else more
                rows, suspects = rows + later, suspects + marked
                if marked and prev is not None and self.row_sr(next((r for r in later if not self.marker(r)), (0, 0))) is not None:
                    suspects = [*suspects, prev]
                last = self.last_sr(more)
                prev = prev if last is None else last
            if rows:
                yield seq, header, rows, sorted(set(suspects))

    def headed(self, header: tuple | None, rows: list[tuple[int, int]]) -> tuple[tuple, list[tuple[int, int]]]:
        """Heading row and data rows (``tables.split_header``)."""
        if header and not _heading(header)[0]:
            return header, rows
        for i, r in enumerate(rows[:6]):
            if text_header_row(self.row(r)):
                return tuple(self.row(r)), rows[i + 1 :]
        return ("",) * max(n for _, n in rows), rows

    def folded(self, rows: list[tuple[int, int]], picked: dict[str, int]) -> list[tuple[int, int, int, bool]]:
        """Number, row and doubt of each record (``merge.fold_tables``)."""
        cells = self.cells
        sr, survey, place = (picked.get(f) for f in ("sr_no", "survey", "village_taluka"))
        rows = [r for r in rows if not self.marker(r)]
        if sr is None:
            return [(i, *r, False) for i, r in enumerate(rows)]
        said = [cells[at + sr] if sr < n else "" for at, n in rows]
        numbers = [parse_sr(c) for c in said]
        if None not in numbers:
            return [(i, *r, False) for i, r in enumerate(rows)]
        has = lambda at, n, col: col is not None and col < n and cells[at + col] != ""
        content = [sr < n and not c and not (has(at, n, survey) and has(at, n, place)) for (at, n), c in zip(rows, said, strict=True)]
        out = []
        for i, (start, size, doubt) in enumerate(merge._runs_of(numbers, [int(c != "") for c in said], content)):
            row = rows[start]
            if size > 1:
                parts = rows[start : start + size]
                row = self.add([" ".join(c for at, n in parts if col < n and (c := cells[at + col])) for col in range(max(n for _, n in parts))])
                if self.marker(row):
                    continue
            out.append((i, *row, doubt))
        return out


def _found(ratio: float):
    ints = lambda x: pa.array(x, pa.int32())

    @F.arrow_udf(_FOUND)
    def run(pages: pa.Array, found: pa.Array) -> pa.Array:
        # a batch makes many small tuples and no cycles: searching for cycles would take a quarter of the time
        was = gc.isenabled()
        gc.disable()
        try:
            return tabled(pages, found)
        finally:
            if was:
                gc.enable()

    def tabled(pages: pa.Array, found: pa.Array) -> pa.Array:
        """The logical tables of each gazette with their records."""
        batch, flags = _Batch(found.flatten(), ratio), [_values(x) for x in pages.flatten().flatten()]
        pages_at, tables_at = _starts(pages), _starts(found)
        out: list[tuple] = []
        ends, recs, rec_ends, picks, suspect_ends, suspects_out = [0], [], [0], [], [0], []
        for g in range(len(pages)):
            lo, hi = tables_at[g], tables_at[g + 1]
            last = {batch.page[k]: k for k in range(lo, hi)}
            first = {batch.page[k]: k for k in range(hi - 1, lo - 1, -1)}
            walked = []
            for no, anchor, closes, note, hint, fresh in zip(*(f[pages_at[g] : pages_at[g + 1]] for f in flags), strict=True):
                k = last.get(no)
                if k is None:
                    walked.append((no, anchor, closes, note, hint, False, False, fresh))
                    continue
                after = first.get(no + 1)
                ends_any = bool(batch.after[k] or after is None or batch.before[after])
                walked.append((no, anchor, closes, note, hint, ends_any and not batch.anchor[k], ends_any, batch.fresh[k]))
            for span_id, (note, start, end, hint) in enumerate(walk(walked)):
                if start is None or end is None:
                    continue
                ks = range(bisect_left(batch.page, start, lo, hi), bisect_right(batch.page, end, lo, hi))
                for seq, header, rows, suspects in batch.stitched(ks) if ks else ():
                    header, rows = batch.headed(header, rows)
                    ok, variant, picked, confidence = mapping._choose(header, hint)
                    if not ok:
                        continue
                    records = batch.folded(rows, picked)
                    recs += records
                    rec_ends.append(len(recs))
                    picks.append([picked.get(f, -1) for f in schemas.FIELDS])
                    suspects_out += suspects
                    suspect_ends.append(len(suspects_out))
                    out.append((span_id, seq, note, start, end, variant, confidence))
            ends.append(len(out))
        number, at, n, doubt = (np.array(x, dtype=kind) for x, kind in zip(zip(*recs, strict=True) if recs else ((),) * 4, ("i8", "i8", "i8", "?"), strict=True))
        cells = pa.concat_arrays([batch.read, pa.array(batch.cells[batch.n_read :], batch.read.type)])
        cols = np.repeat(np.array(picks, dtype="i8").reshape(-1, len(schemas.FIELDS)), np.diff(rec_ends), axis=0)
        raw = [cells.take(pa.array(at + c, mask=(c < 0) | (c >= n))) for c in cols.T]
        records = pa.StructArray.from_arrays([pa.array(number), pa.array(doubt), pa.StructArray.from_arrays(raw, list(schemas.FIELDS))], ["record_id", "disputed", "raw"])
        names = ("span_id", "table_seq", "notification_no", "page_start", "page_end", "variant", "confidence")
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64())
        plain = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True) if out else ((),) * len(names), kinds, strict=True)]
        listed = [pa.ListArray.from_arrays(ints(suspect_ends), ints(suspects_out)), pa.ListArray.from_arrays(ints(rec_ends), records)]
        return pa.ListArray.from_arrays(ints(ends), pa.StructArray.from_arrays([*plain, *listed], [*names, "suspect_sr", "records"]))

    return run


def find_records(meta: DataFrame, pages: DataFrame, raw_tables: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """One row per record: keys of its table, ``record_id``, ``raw`` (struct of fields), ``disputed`` and what
    its table has.  A gazette's pages and tables stand in one row; all steps share its partition."""
    marks = spans.page_marks(pages, cfg)
    listed = marks.groupBy("gazette_id").agg(
        F.sort_array(F.collect_list(F.struct("page_no", "anchor", "closes", "notification_no", "variant_hint", "fresh"))).alias("_pages")
    )
    edges = spans.edge_marks(raw_tables.where(F.col("page_no").isNotNull()), cfg)
    kept = ("page_no", "n_cols", "body_before", "body_after", "header", "grid", "anchor_after", "tail_fresh")
    ranked = edges.select("gazette_id", F.struct("page_no", F.coalesce("idx", F.lit(0)).alias("idx"), *kept[1:]).alias("_t"))
    tabled = ranked.groupBy("gazette_id").agg(F.sort_array(F.collect_list("_t")).alias("_ts"))
    named = listed.join(tabled, "gazette_id").join(meta.select("gazette_id", "source_filename"), "gazette_id", "left")
    return named.select("*", F.explode(_found(cfg.header_ratio)(F.col("_pages"), F.col("_ts"))).alias("_t"))
