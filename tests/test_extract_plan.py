"""The extraction's cost: what it must not do for every row, and that the cheaper tests say the same."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.functions import cells as ce
from cadastra.functions import text as tx
from cadastra.operators import mapping, merge
from cadastra.plans import extract


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _given(spark):
    meta = spark.createDataFrame([("g", "g.pdf", "x", 1)], schemas.META)
    pages = spark.createDataFrame([("g", 1, "Section 39A change of zone")], schemas.PAGES)
    tables = spark.createDataFrame([("g", 0, 1, 1, 2, ["Sr", "Survey"], [["1.", "5/1"]], None, None)], schemas.TABLES)
    return meta, pages, tables


def test_rows_are_not_windowed_and_headings_not_searched_by_pattern(spark):
    plan = _plan(extract.extract_rows(*_given(spark)))
    assert "Window" not in plan and "name of the applicant" not in plan.replace(r"\Q", "")


def test_plots_window_only_for_repeated_numbers(spark):
    plots = extract.extract(*_given(spark))["plots"]
    assert _plan(plots).count("Window [") == 1
    assert [r.survey_number for r in plots.collect()] == []  # a row without a place is not accepted


def test_strip_equals_the_pattern(spark):
    rng = random.Random(5)
    odd = [*tx.WHITE, "a", "​", "\x1c", "é", "", " \n"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 6))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(tx.strip(F.col("t")) != F.regexp_replace("t", r"(?U)^\s+|\s+$", "")).count() == 0


def test_number_rows(spark):
    rows = [["1", "2", "3"], ["(1)", "", "2. 3"], ["1", "2"], ["1", "3", "2"], ["1", "2", "x"], ["1", None, "2", "3"], [], ["1 2\n3"], ["1", "2", "123"]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, r array<string>")
    got = {x.i for x in df.where(ce.is_column_number_row(F.col("r"))).collect()}
    assert got == {0, 1, 5, 7}


def test_runs_against_the_rules():
    rng = random.Random(3)
    for _ in range(3000):
        n = rng.randint(1, 8)
        sr = [rng.choice([None, None, rng.randint(1, 6)]) for _ in range(n)]
        filled = [int(s is not None or rng.random() < 0.2) for s in sr]
        content = [not f and rng.random() < 0.7 for f in filled]
        continues, clash = [], []
        for i in range(n):
            by, verdict = content[i] and i > 0, None
            lo = max((j for j in range(i) if sr[j] is not None), default=None)
            hi = min((j for j in range(i + 1, n) if sr[j] is not None), default=None)
            if sr[i] is None and lo is not None and hi is not None and sum(filled[lo + 1 : hi + 1]) == 1 and sr[hi] > sr[lo]:
                verdict = True if sr[hi] == sr[lo] + 1 else False if sr[hi] - sr[lo] - 1 == hi - lo - 1 else None
            continues.append(by if verdict is None else verdict)
            clash.append(continues[-1] != by)
        record = [sum(not c for c in continues[: i + 1]) - 1 for i in range(n)]
        doubt = {r for r, k in zip(record, clash, strict=True) if k} | {r - (not c) for r, c, k in zip(record, continues, clash, strict=True) if k}
        want = [(record.index(r), record.count(r), r in doubt) for r in sorted(set(record))]
        assert merge._runs_of(sr, filled, content) == want


def test_equal_headings_are_read_once():
    mapping._choose.cache_clear()
    head = ("Sr", "Survey", "Decision")
    assert mapping._choose(head, None) == mapping._choose(head, None) == (True, "ndz", {"sr_no": 0, "survey": 1, "decision": 2}, 0.9)
    assert mapping._choose.cache_info().hits == 1
