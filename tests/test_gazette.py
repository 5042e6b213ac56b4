"""Whole gazettes in one pass against the single operators, on odd tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.functions import scalars as sc
from cadastra.operators import gazette
from cadastra.plans import extract

H8 = ["Sr. No.", "Name of the applicant", "Sy. No.", "Village/Taluka", "Published use", "Proposed land use", "Area proposed", "Decision of TCP Board"]
H7 = ["Sr No", "Survey", "Village", "RPG", "Proposed land use", "In sq m", "Decision"]
NUMBERS = ["1", "2", "3", "4", "5", "6", "7", "8"]
TEXTS = ["Section 39A change of zone", "Notification No. 5\nSection 39A", "No Development Zone", "x", "| Section 39A |", None,
    "And whereas, in terms of sub-rule (1) of rule 4", "And whereas, in terms of sub-rule (1) of rule 4\nNotification No. 6/39A\nchange of zone"]
AROUND = [None, None, None, [], ["12"], ["Some text"], ["SERIES III No. 5", " "], ["Notification No. 7", "Section 39A"], [None]]


def _cell(rng):
    return rng.choice(["", " ", None, "x", "5/1", "v, Ponda", "\xa07.", "2. 3/1", "over 4. 7/2", "\U0001f600 a", "12\n", "1 2", "(3)", "Recommended", "sr", "survey", "3\x85", "no", "development"])


def _gazette(rng, g):
    pages = [(g, n, rng.choice(TEXTS)) for n in rng.sample(range(1, 8), rng.randint(1, 6)) for _ in range(rng.choice([1] * 9 + [2]))]
    pages += [(g, None, "Section 39A")] if rng.random() < 0.05 else []
    tables, sr = [], 0
    for i in range(rng.randint(0, 6)):
        header = rng.choice([H8, H8, H7, None, None, NUMBERS, ["1 2", *NUMBERS[2:]], ["2", *NUMBERS[2:]], [None, " "], ["a"] * 8, []])
        grid = [list(rng.choice([H8, H7]))] if rng.random() < 0.3 else []
        for _ in range(rng.randint(0, 5)):
            sr += rng.choice([1, 1, 1, 2, 0])
            kind = rng.random()
            row = [f"{sr}." if kind < 0.6 else rng.choice(["", "-"]), "who", rng.choice(["", "5/1"]), rng.choice(["", "v, Ponda"]), "Orchard, 5", "x", "5", rng.choice(["Recommended", "7"])]
            row = NUMBERS if kind > 0.95 else [_cell(rng) for _ in range(rng.randint(0, 9))] if kind > 0.85 else [f"{sr}. 5/1", *row[1:7]] if kind > 0.8 else row
            grid.append(row if rng.random() < 0.97 else None)
        page = rng.choice([None, *[p[1] for p in pages] * 5, 9])
        tables.append((g, rng.choice([None, i, i]), page, len(grid), rng.choice([8, 8, 8, 7, None]), header, grid if rng.random() < 0.97 else None, rng.choice(AROUND), rng.choice(AROUND)))
    seen, kept = set(), []
    for t in tables:  # two tables of one page and index have no order
        if (t[2], t[1] or 0) not in seen:
            seen.add((t[2], t[1] or 0))
            kept.append(t)
    return pages, kept


def test_one_pass_gives_the_records_of_the_single_operators(spark):
    rng, pages, tables = random.Random(11), [], []
    for g in range(600):
        p, t = _gazette(rng, f"g{g}")
        pages += p
        tables += t
    meta = spark.createDataFrame([(f"g{g}", f"g{g}.pdf", "x", 1) for g in range(0, 600, 2)], schemas.META)
    given = meta, spark.createDataFrame(pages, schemas.PAGES), spark.createDataFrame(tables, schemas.TABLES)
    one = extract.records_at_once(*given)
    names = sorted(one.columns)
    got, want = ([repr(r) for r in df.select(*names).collect()] for df in (one, extract.stepwise(*given).select(*names)))
    assert len(want) > 500 and sorted(got) == sorted(want)


def test_cells_are_walked_once(spark):
    """The records come from one Python step, without a pattern for each cell or row in the plan."""
    meta = spark.createDataFrame([("g", "g.pdf", "x", 1)], schemas.META)
    pages = spark.createDataFrame([("g", 1, "Section 39A change of zone")], schemas.PAGES)
    tables = spark.createDataFrame([("g", 0, 1, 1, 8, H8, [["1.", "w", "5/1", "v, Ponda", "x", "y", "5", "Recommended"]], None, None)], schemas.TABLES)
    rows = extract.extract_rows(meta, pages, tables)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "{1,3}" not in plan.split("ArrowEvalPython", 1)[1]
    assert [(r.sr_no, r.survey_raw, r.taluka, r.decision) for r in rows.collect()] == [("1.", "5/1", "Ponda", "Recommended")]


def test_number_rows_and_serial_numbers():
    assert gazette.number_row(["1", "(2)", "3."]) and not gazette.number_row(["1", "3", "2"]) and not gazette.number_row(["1", "2"])
    assert [gazette.parse_sr(c) for c in ("12.", " 3 x", "4x", "\xa05", "6\x85", "1234", "")] == [12, 3, None, None, 6, None, None]


def test_single_ranges_equal_the_general_form(spark):
    """A text of one range is read without patterns: same numbers as with a blank item behind it."""
    raws = ["5/3 to 7", "5/7 to 3", "05/07 to 9", "5/3 to 3", "5/3 to 7\n", "5/3 TO 4", f"1/{'9' * 38} to {'9' * 38}", f"1/{'9' * 39} to {'9' * 39}", "5/3 to 7 (P)", "5/3  to 4", "15/3 to 7x"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    read = lambda c: [tuple(r) for r in sc.explode_surveys(df.select("i", c.alias("raw")), F.col("raw")).drop("raw").orderBy("i", "survey_number").collect()]
    assert read(F.col("raw")) == read(F.concat("raw", F.lit(", ")))
    assert [r[1] for r in read(F.col("raw")) if r[0] == 0] == ["5/3", "5/4", "5/5", "5/6", "5/7"]
