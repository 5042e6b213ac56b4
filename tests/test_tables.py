import random

import pytest
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.operators import mapping, merge, tables

H8 = ["Sr. No.", "Name of the applicant", "Sy. No.", "Village/Taluka", "Published use", "Proposed land use", "Area proposed", "Decision of TCP Board"]


def chains(spark, specs):
    """specs: (page, n_cols, header, grid, before, after) -> rows of each stitched table."""
    rows = [("g", i, p, len(g), n, h, g, b, a) for i, (p, n, h, g, b, a) in enumerate(specs)]
    df = spark.createDataFrame(rows, schemas.TABLES)
    for name, value in (("span_id", 0), ("page_start", 1), ("page_end", 99)):
        df = df.withColumn(name, F.lit(value))
    df = df.withColumns({"notification_no": F.lit("n"), "variant_hint": F.lit(None).cast("string")})
    return [(r.rows, r.suspect_sr, r.header) for r in tables.stitch(df).orderBy("table_seq").collect()]


def test_continues_on_the_next_page(spark):
    got = chains(spark, [(1, 2, ["Sr", "Survey"], [["1.", "a"]], None, None), (2, 2, ["Sr", "Survey "], [["Sr", "Survey"], ["2.", "b"]], ["12"], None)])
    assert [x[0] for x in got] == [[["1.", "a"], ["2.", "b"]]]


@pytest.mark.parametrize(
    "second",
    [
        (3, 2, None, [["2.", "b"]], None, None),  # not the next page
        (2, 3, None, [["2.", "b", "c"]], None, None),  # other columns
        (2, 2, None, [["2.", "b"]], ["Some text"], None),  # text in between
        (2, 2, ["Receipt", "Book"], [["2.", "b"]], None, None),  # other header
        (2, 2, None, [["1.", "b"]], None, None),  # numbering starts again
    ],
)
def test_breaks(spark, second):
    assert len(chains(spark, [(1, 2, ["Sr", "Survey"], [["1.", "a"]], None, None), second])) == 2


def test_column_split_and_suspects(spark):
    grid = [["overflow 2. 203/1", "x"], ["3. 7/1", "y"], ["more", "z"], ["", ""]]
    got = chains(spark, [(1, 3, ["1", "2", "3"], [["1.", "5/1", "p"]], None, None), (2, 2, ["1 2", "3", "4"], grid, None, None)])
    assert got[0][0] == [["1.", "5/1", "p"], ["", "overflow", ""], ["2.", "203/1", "x"], ["3.", "7/1", "y"], ["", "more", "z"], ["", "", ""]]
    assert got[0][1] == [3]


def test_previous_number_is_suspect_when_no_overflow_precedes(spark):
    got = chains(spark, [(1, 3, ["1", "2", "3"], [["1.", "5/1", "p"]], None, None), (2, 2, ["2", "3", "4"], [["2. 7/1", "y"]], None, None)])
    assert sorted(got[0][1]) == [1, 2]


def split(spark, header, rows):
    df = spark.createDataFrame([(header, rows)], "header array<string>, rows array<array<string>>")
    r = tables.split_header(df).first()
    return r.header, r.rows


def test_split_header(spark):
    assert split(spark, ["a", "b"], [["1", "2"]]) == (["a", "b"], [["1", "2"]])
    assert split(spark, None, [["t", ""], ["Sr", "Survey"], ["1", "2"]]) == (["Sr", "Survey"], [["1", "2"]])
    assert split(spark, ["1", "2", "3"], [["x"], ["y", "z"]]) == (["", ""], [["x"], ["y", "z"]])


def answer(spark, text, n=8, samples=(("1", "a", "b", "c", "d", "e", "300", "Recommended"),)):
    df = spark.createDataFrame([(text, n, [list(s) for s in samples])], "a string, n int, s array<array<string>>")
    return df.select(mapping.check_answer(F.col("a"), F.col("n"), F.col("s")).alias("m")).first().m


GOOD = '{"is_39a": true, "variant": "change_of_zone", "column_map": {"sr_no": 0, "applicant": 1, "survey": 2, "village_taluka": 3, "existing_use": 4, "proposed_use": 5, "area_proposed": 6, "decision": 7}}'


def test_answers(spark):
    m = answer(spark, GOOD)
    assert m.is_39a and m.confidence == 0.85 and m.column_map.decision == 7
    assert answer(spark, '{"is_39a": false}').confidence == 0.5
    for bad in (
        "nonsense", "{}", GOOD.replace('"survey": 2', '"survey": null'), GOOD.replace('"survey": 2', '"survey": 8'), GOOD.replace('"survey": 2', '"survey": "2"'),
        GOOD.replace('"survey": 2', '"survey": 1'), GOOD.replace('"survey": 2', '"survey": true'), GOOD.replace("change_of_zone", "zone"),
        GOOD.replace('"decision": 7', '"decision": 5').replace('"proposed_use": 5', '"proposed_use": 7'), GOOD.replace('"area_proposed": 6', '"area_proposed": 4').replace('"existing_use": 4', '"existing_use": 6'),
    ):
        assert answer(spark, bad) is None, bad


def test_model_only_adds_tables(spark):
    asked = []
    df = spark.createDataFrame([(1, H8, None, [["1"] * 7 + ["Recommended"]]), (2, ["a"] * 8, None, [["1", "a", "b", "c", "d", "e", "30", "recommended"]]), (3, ["b"] * 8, None, [["1"]])], "id int, header array<string>, variant_hint string, rows array<array<string>>")

    def transport(prompt):
        if '"header":"b"' in prompt:
            raise RuntimeError("down")
        return GOOD

    got = {r.id: r.mapped for r in mapping.map_columns(df, transport).collect()}
    assert not asked and [got[i].confidence for i in (1, 2, 3)] == [0.9, 0.85, 0.3]


def naive_merge(rows, sr, survey, place):
    """Row after row: (cells of the records, disputed records)."""
    import re

    def number(c):
        m = re.match(r"\s*(\d{1,3})\s*[.)]?(?:\s|$)", c)
        return int(m[1]) if m else None

    numbered = [i for i, r in enumerate(rows) if number(r[sr]) is not None]
    ruled = {}
    for a, b in zip(numbered, numbered[1:]):
        inner = range(a + 1, b)
        step = number(rows[b][sr]) - number(rows[a][sr])
        if step <= 0 or any(rows[i][sr] for i in inner):
            continue
        if step == 1 or step - 1 == len(inner):
            ruled |= {i: step == 1 for i in inner}
    out, doubt = [], set()
    for i, r in enumerate(rows):
        content = bool(out) and not r[sr] and not (r[survey] and r[place])
        joins = ruled.get(i, content)
        if joins != content:
            doubt |= {len(out) - 1} | (set() if joins else {len(out)})
        if joins:
            out[-1] = [" ".join(x for x in p if x) for p in zip(out[-1], r)]
        else:
            out.append(list(r))
    return out, doubt


def test_merge_matches_naive_fold(spark):
    rng, data, want = random.Random(8), [], {}
    for g in range(400):
        rows, n = [], 0
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            n += rng.choice([1, 1, 1, 2, 3, -1])
            sr = f"{n}." if kind < 0.45 and n > 0 else ("-" if kind > 0.93 else "")
            rows.append([sr, rng.choice(["", "s"]), rng.choice(["", "v"]), rng.choice("abc")])
        want[str(g)] = naive_merge(rows, 0, 1, 2)
        data += [(str(g), 0, 0, i, r, 0, 1, 2) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "gazette_id string, span_id int, table_seq int, row_idx int, cells array<string>, sr_col int, survey_col int, place_col int")
    got = {}
    for r in merge.fold_records(merge.number_records(df)).orderBy("gazette_id", "record_id").collect():
        cells, doubt = got.setdefault(r.gazette_id, ([], set()))
        if r.disputed:
            doubt.add(len(cells))
        cells.append(r.cells)
    assert got == want


def test_no_serial_column_never_continues(spark):
    df = spark.createDataFrame([("g", 0, 0, i, ["", "x"], None, 0, 1) for i in range(3)], "gazette_id string, span_id int, table_seq int, row_idx int, cells array<string>, sr_col int, survey_col int, place_col int")
    assert merge.fold_records(merge.number_records(df)).count() == 3
