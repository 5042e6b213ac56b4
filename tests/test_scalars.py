import hashlib

import pytest
from pyspark.sql import functions as F

from cadastra.functions import cells as ce
from cadastra.functions import scalars as sc
from cadastra.functions import text as tx


def values(spark, make, inputs, kind="string"):
    df = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [r.v for r in df.select("i", make(F.col("x")).alias("v")).orderBy("i").collect()]


def test_indian_int(spark):
    got = values(spark, sc.indian_int, ["13,80,498", "301.68", "1 2 3", "Orchard, Zone 300", "Orchard, 300", "", None, "none", "x" * 5 + "9" * 30])
    assert got == [1380498, 301, 123, None, 300, None, None, None, None]


def test_total_area(spark):
    assert values(spark, sc.total_area, ["Total Area (1380498)", "total  area ( 12,5 m2)", "Total Area (none) 7", "RPG 2021 x", None]) == [1380498, 125, None, 2021, None]


def test_area_breakdown(spark):
    got = values(spark, sc.area_breakdown, ["Partly Orchard (12m2), partly Paddy field (7m2)", "none", None])
    assert [[(e.use, e.sqm) for e in x] for x in got] == [[("Orchard", 12), ("Paddy field", 7)], [], []]


def test_place(spark):
    got = values(spark, sc.split_place, ["Siolim, Bardez", "Parra,", " PONDA ", "a,b,c", "", " , ", None])
    assert [(x.village, x.taluka) if x else None for x in got] == [("Siolim", "Bardez"), ("Parra", None), (None, "PONDA"), ("a", "c"), (None, None), (None, None), (None, None)]


def test_known_taluka(spark):
    assert values(spark, sc.is_known_taluka, [" ponda ", "Ponda ", "x", "", None]) == [True, True, False, False, False]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("490/2-L", [("490/2-L", False)]),
        ("78/5-A (Part)", [("78/5-A", True)]),
        ("201/1 to 3, 193/0 (P)", [("201/1", False), ("201/2", False), ("201/3", False), ("193/0", True)]),
        ("5/3 to 1, 9/1", [("9/1", False)]),
        ("256/2, Plot No. 51", [("256/2", False), ("Plot No. 51", False)]),
        ("25, 22/1 & 2, pt, (P)", [("22/1", False)]),
        ("136/3- A", [("136/3", False)]),
        ("4/1 to 2 (P)\n, 4/2, 4/1 (Part)", [("4/1", True), ("4/2", True)]),
        ("", []),
        (None, []),
    ],
)
def test_survey(spark, raw, want):
    got = sc.explode_surveys(spark.createDataFrame([(raw,)], "raw string"), F.col("raw")).collect()
    assert [(e.survey_number, e.is_part) for e in got] == want


def test_survey_ranges_are_whole(spark):
    raws = [(0, "1/1 to 250000, 1/7, 1/07, 2/9"), (1, "3/5 to 9, 3/8 to 12 (P), 3/10, 4/10, 3/13"), (2, "1/" + "9" * 25 + " to 1" + "0" * 25), (3, "7/1 to " + "9" * 40)]
    got = sc.explode_surveys(spark.createDataFrame(raws, "i int, raw string"), F.col("raw"))
    first = got.where("i = 0")
    assert first.count() == first.select("survey_number").distinct().count() == 250_002
    assert first.where("survey_number in ('1/250000', '1/07', '2/9')").count() == 3
    rows = {i: {(r.survey_number, r.is_part) for r in got.where(F.col("i") == i).collect()} for i in (1, 2, 3)}
    assert rows[1] == {(f"3/{n}", n > 9) for n in range(5, 13)} | {("4/10", False), ("3/13", False)}
    assert rows[2] == {("1/" + "9" * 25, False), ("1/1" + "0" * 25, False)}
    assert rows[3] == set()


def test_hashes(spark):
    df = spark.createDataFrame([("g", None, "1", None, "d", "7/1")], "g string, n string, s string, v string, d string, p string")
    r = df.select(sc.row_hash(F.col("g"), F.col("n"), F.col("s"), F.col("v"), F.col("d")).alias("a"), sc.plot_hash(F.col("g"), F.col("n"), F.col("s"), F.col("p")).alias("b")).first()
    assert r.a == hashlib.sha256(b"g||1||d").hexdigest()
    assert r.b == hashlib.sha256(b"g|None|1|7/1").hexdigest()


def test_slug_and_names(spark):
    assert values(spark, sc.slugify, [" A b__c?.pdf ", "???", "x" * 100]) == ["A_b_c_.pdf", "gazette", "x" * 80]
    got = values(spark, sc.filename_meta, ["SIII-OG21 2026-08-06.pdf", "SIIIOG7 5th Aug 2026.pdf", "x.pdf"])
    assert [tuple(x) for x in got] == [("SIII", "21", "2026-08-06"), ("SIII", "7", "2026-Aug-5"), (None, None, None)]


def test_serial_numbers_of_cells_and_of_validation_differ(spark):
    cells = ["5.", "(5)", " 12) x", "1234", "-", "", None, "3x"]
    assert values(spark, ce.parse_sr, cells) == [5, None, 12, None, None, None, None, None]
    assert values(spark, sc.validation_sr, cells) == [5, 5, 12, 1234, None, None, None, 3]


def test_rows(spark):
    rows = [["1", "", "3"], ["(1)", "(2)", "(3)"], ["1", "2", "4", "3"], ["0", "1", "2"], ["1", "2"], ["1 2", "3."], ["Sr. No", "Survey"], ["Sr", "x"], ["", " "], []]
    number = values(spark, ce.is_column_number_row, rows, "array<string>")
    assert number == [False, True, False, True, False, True, False, False, False, False]
    assert values(spark, ce.is_text_header_row, rows, "array<string>") == [False] * 6 + [True, False, False, False]
    assert values(spark, ce.is_marker_row, rows, "array<string>") == [False, True, False, True, False, True, False, False, True, True]
    assert values(spark, ce.folds_first_column, [["1 2", "3", "4"], ["2", "3", "4"], ["1", "2", "3"], ["x"], []], "array<string>") == [True, True, False, False, False]


def test_text(spark):
    assert values(spark, tx.strip, ["  a b\t\n"]) == ["a b"]
    assert values(spark, tx.notification_no, ["x\nNotification No. 39A/1 \r\nrest", "notification no", None]) == ["39A/1", None, None]
    assert values(spark, tx.variant_hint, ["no development zone Section 39A", "Change of Zone", "x"]) == ["ndz", "change_of_zone", None]
    assert values(spark, tx.prose, ["a\n  | Section 39A |\nb"]) == ["a\nb"]
    assert values(spark, tx.page_class, ["", "x" * 49, " " + "x" * 50, None]) == ["scanned", "scanned", "digital", "scanned"]
