"""Span detection against a direct restatement of the walk, and on typical layouts."""

import random

import pytest

from cadastra import schemas
from cadastra.operators import spans

START = "Notification No. 7/39A\nPowers under Section 39A"
CLOSE = "And whereas, in terms of sub-rule (1) of rule 4"


def find(spark, pages, tables=()):
    p = spark.createDataFrame([("g", n, t) for n, t in pages.items()], schemas.PAGES)
    t = spark.createDataFrame([("g", i, n, 1, 2, None, [["a", "b"]], b, a) for i, (n, b, a) in enumerate(tables)], schemas.TABLES)
    return [(r.page_start, r.page_end) for r in spans.find_spans(p, t).orderBy("span_id").collect()]


@pytest.mark.parametrize(
    "pages, tables, want",
    [
        ({10: START, 11: "x", 12: "y", 13: CLOSE}, (), [(10, 13)]),
        ({7: START, 8: "| Section 39A |", 9: CLOSE + "\n| change of zone |"}, (), [(7, 9)]),
        ({7: START, 8: "x", 9: "y", 10: "z"}, [(8, None, ["It is decided."])], [(7, 8)]),
        ({2: START, 3: "x", 4: "y"}, [(3, None, None), (4, ["Another matter"], None)], [(2, 3)]),
        ({7: START, 8: "x", 9: CLOSE + "\nSection 39A"}, (), [(7, 9)]),
        ({2: START, 3: "x", 4: CLOSE + "\nNotification No. 8\nSection 39A", 5: "y"}, (), [(2, 4), (4, 5)]),
        ({1: START}, [(1, None, None)], [(1, 1)]),
        ({1: "a"}, (), []),
        ({}, (), []),
    ],
)
def test_layouts(spark, pages, tables, want):
    assert find(spark, pages, tables) == want


def walk(flags):
    """The walk as a loop: ``flags`` is a list of dicts in page order."""
    out, i = [], 0
    while i < len(flags):
        if not flags[i]["anchor"]:
            i += 1
            continue
        start, end, j, stopped = flags[i]["page_no"], flags[i]["page_no"], i + 1, False
        if not flags[i]["ends_start"]:
            while j < len(flags):
                p = flags[j]
                if p["closes"] and p["page_no"] > start + 1:
                    end, stopped = p["page_no"], True
                elif p["anchor"]:
                    end = flags[j - 1]["page_no"]
                    break
                else:
                    end, stopped = p["page_no"], p["ends_any"]
                if stopped:
                    break
                j += 1
        out.append((start, end))
        i = max(i + 1, j + 1 if stopped and not flags[j]["fresh"] else j)
    return out


def test_walk_matches_loop(spark):
    rng, rows, want = random.Random(3), [], {}
    for g in range(300):
        page, flags = 0, []
        for _ in range(rng.randint(0, 9)):
            page += rng.choice([1, 1, 1, 2])
            flags.append({"page_no": page} | {k: rng.random() < p for k, p in (("anchor", 0.4), ("closes", 0.3), ("ends_start", 0.2), ("ends_any", 0.2), ("fresh", 0.5))})
        want[str(g)] = walk(flags)
        rows += [(str(g), f["page_no"], f["anchor"], f["closes"], None, None, f["ends_start"], f["ends_any"], f["fresh"]) for f in flags]
    df = spark.createDataFrame(rows, "gazette_id string, page_no int, anchor boolean, closes boolean, notification_no string, variant_hint string, ends_start boolean, ends_any boolean, fresh boolean")
    got = {}
    for r in spans.walk_spans(df).orderBy("gazette_id", "span_id").collect():
        got.setdefault(r.gazette_id, []).append((r.page_start, r.page_end))
    assert got == {g: s for g, s in want.items() if s}


def test_shared_page_counts_twice(spark):
    t = spark.createDataFrame([("g", 0, 4), ("h", 0, 4)], "gazette_id string, idx int, page_no int")
    s = spark.createDataFrame([("g", 0, None, 2, 4, None), ("g", 1, None, 4, 5, None)], "gazette_id string, span_id int, notification_no string, page_start int, page_end int, variant_hint string")
    assert spans.tables_in_spans(t, s).count() == 2
