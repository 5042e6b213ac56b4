"""Validation, review, mails, files, Markdown, chunks, artifacts and the command line."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from cadastra import __main__ as cli
from cadastra import schemas
from cadastra.config import EngineConfig
from cadastra.operators import documents, records
from cadastra.sources import artifacts, sinks

ROW = schemas.APPLICATION + ", review_reason string, row_seq int"


def rows_of(spark, *given):
    """Rows from (sr_no, notification_no, changed fields), in order, of gazette g."""
    base = dict(gazette_id="g", survey_raw="1/1", village="Marcaim", taluka="Ponda", decision="Recommended", confidence=0.9, page_from=1, page_to=1)
    made = [{**base, "sr_no": sr, "notification_no": n, "row_hash": f"h{i}", "row_seq": i, **more} for i, (sr, n, more) in enumerate(given)]
    return spark.createDataFrame([tuple(r.get(c) for c in (*schemas.APPLICATION_COLUMNS, "review_reason", "row_seq")) for r in made], ROW)


def judged(spark, *given):
    good, issues = records.validate(rows_of(spark, *given))
    return sorted(r.row_seq for r in good.collect()), sorted((i.row and i.row.sr_no or "", i.reason, i.severity) for i in issues.collect())


def test_duplicates_and_gaps_are_per_notification(spark):
    assert judged(spark, ("1.", "N1", {}), ("2.", "N1", {}), ("1.", "N2", {}), ("2.", "N2", {})) == ([0, 1, 2, 3], [])
    good, issues = judged(spark, ("1.", "N1", {}), ("1.", "N1", {}))
    assert good == [0] and issues == [("1.", "Duplicate sr_no 1", "error")]
    good, issues = judged(spark, ("1.", "N1", {}), ("3.", "N1", {}), ("7.", "N1", {}), ("10.", "N2", {}), ("11.", "N2", {}))
    assert good == [0, 1, 2, 3, 4]  # a gap is a warning, and only the first counts
    assert issues == [("", "Non-monotonic sr_no sequence gap between 1 and 3 (notification N1)", "warning")]
    assert judged(spark, ("1.", None, {}), ("3.", "", {})) == ([0, 1], [])  # null and empty are two notifications
    assert judged(spark, ("2", None, {}), ("4", None, {}))[1][0][1].endswith("(notification unknown)")


@pytest.mark.parametrize(
    "changed, reasons",
    [
        ({"survey_raw": None}, ["Missing survey numbers"]),
        ({"survey_raw": ""}, ["Missing survey numbers"]),
        ({"taluka": None}, ["Missing taluka"]),
        ({"taluka": "Pontaim"}, ["Unknown taluka: Pontaim"]),
        ({"taluka": " ponda "}, []),
        ({"review_reason": "Survey numbers may be mixed"}, ["Survey numbers may be mixed"]),
        ({"review_reason": "mixed", "survey_raw": None, "taluka": "X"}, ["Missing survey numbers", "Unknown taluka: X", "mixed"]),
        ({"sr_no": None}, []),
    ],
)
def test_reasons(spark, changed, reasons):
    good, issues = judged(spark, ("1.", "N1", {}), ("2.", "N1", changed))
    assert good == ([0] if reasons else [0, 1]) and sorted(i[1] for i in issues) == sorted(reasons) and {i[2] for i in issues} <= {"error"}


def test_empty_rows(spark):
    assert judged(spark) == ([], [])


def test_review_reasons_of_extraction(spark):
    raw = ", ".join(f"{f}: string" for f in schemas.FIELDS)
    made = [(str(i), sr, suspect, disputed) for i, (sr, suspect, disputed) in enumerate([("1.", [1], False), ("2.", [1], False), ("3.", [3], True), (None, [3], True), ("4.", None, False)])]
    df = spark.createDataFrame(made, "gazette_id string, sr string, suspect_sr array<int>, disputed boolean")
    values = [F.col("sr").alias("sr_no"), F.lit("who").alias("applicant"), *[F.lit("x").alias(f) for f in schemas.FIELDS[2:]]]
    keys = {c: F.lit(0) for c in ("page_start", "page_end", "span_id", "table_seq", "record_id")} | {c: F.lit("n") for c in ("source_filename", "notification_no")}
    df = df.withColumns({**keys, "variant": F.lit("ndz"), "confidence": F.lit(0.9), "raw": F.struct(*values).cast(f"struct<{raw}>")})
    got = {r.gazette_id: r for r in records.application_rows(df).collect()}
    assert [got[str(i)].review_reason for i in range(5)] == [records.MIXED_SURVEY, None, f"{records.MIXED_SURVEY} {records.DISPUTED_SPLIT}", records.DISPUTED_SPLIT, None]
    assert got["0"].applicant is None  # the variant has no applicants


def test_digest_lines(spark):
    rows = rows_of(spark, *[(f"{i}.", "N1", {}) for i in range(1, 23)]).withColumn("decision", F.when(F.col("row_seq") == 0, None).otherwise(F.col("decision")))
    _, issues = records.validate(rows_of(spark, ("1.", "N1", {"taluka": None}), ("4.", "N1", {})))
    d = records.digest(rows, issues.withColumn("gazette_id", F.lit("g"))).first()
    assert d.subject == "Gazette 39A — 22 new application(s)" and len(d.lines) == 21 and d.lines[-1] == "... and 2 more"
    assert d.lines[:2] == ["- 1. | N/A | Marcaim, Ponda | ", "- 2. | N/A | Marcaim, Ponda | Recommended"]
    assert (d.n_issues, d.n_errors, d.n_warnings) == (2, 1, 1)
    assert d.review_lines == ["- [error] Missing taluka — notification N1, Sr. 1.", "- [warning] Non-monotonic sr_no sequence gap between 1 and 4 (notification N1)"]
    only = records.digest(rows.limit(0), issues).first()
    assert only.subject == "Gazette 39A — 2 issue(s) need review" and only.lines == []


def test_files_of_a_run(spark, tmp_path):
    rows = rows_of(spark, ("1.", "N1", {"applicant": 'A "b", c'}), ("2.", "N1", {"taluka": None}))
    good, issues = records.validate(rows)
    sink = sinks.FileSink(str(tmp_path))
    assert sink.append_rows(good, records.plots(good), issues, "r") == 1
    read = lambda name: [json.loads(x) for p in sorted((tmp_path / name).glob("part*")) for x in p.read_text().splitlines()]
    assert [r["sr_no"] for r in read("run_r.rows.json")] == ["1."] and read("run_r.rows.json")[0]["total_area_sqm"] is None
    assert list(read("run_r.rows.json")[0]) == list(schemas.APPLICATION_COLUMNS)
    assert [r["survey_number"] for r in read("run_r.plots.json")] == ["1/1"]
    assert [(r["reason"], r["severity"], r["row"]["sr_no"]) for r in read("run_r.review.json")] == [("Missing taluka", "error", "2.")]
    csv = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "run_r.rows.csv")).first()
    assert (csv.applicant, csv.sr_no, csv.total_area_sqm) == ('A "b", c', "1.", None)
    assert sink.append_rows(good.limit(0), records.plots(good.limit(0)), issues.limit(0), "none") == 0 and not list(tmp_path.glob("run_none*"))


def test_markdown_of_pages(spark):
    pages = [("a", 7, "alpha"), ("a", 5, "beta\n\ngamma \n"), ("b", 1, "x"), ("b", 2, None), ("b", 3, "y"), ("c", None, "alone")]
    got = {r.gazette_id: r.markdown for r in documents.to_markdown(spark.createDataFrame(pages, schemas.PAGES)).collect()}
    assert got["a"] == "[Page 5]\n\nbeta\n\ngamma\n\n---\n\n[Page 7]\n\nalpha\n"
    assert got["b"] == "[Page 1]\n\nx\n\n---\n\n[Page 2]\n\n---\n\n[Page 3]\n\ny\n" and got["c"] == "alone"


def naive_chunks(blocks, limit):
    """Word by word: a block that fits is one part, a longer one is cut at words; a chunk takes parts while they fit."""
    out, held, pages, heading = [], [], set(), None

    def close():
        if held:
            out.append(("\n".join(held), sorted(pages), heading))
        held.clear()
        pages.clear()

    for head, page, text in blocks:
        if (head or None) != heading:
            close()
            heading = head or None
        words = text.split()
        parts = [text] if words and len(words) <= limit else [" ".join(words[i : i + limit]) for i in range(0, len(words), limit)]
        for part in parts:
            if sum(len(h.split()) for h in held) + len(part.split()) > limit:
                close()
            held.append(part)
            pages.add(page)
    close()
    return out


def test_chunks_against_brute_force(spark):
    rng = random.Random(5)
    docs = {str(d): [(rng.choice([None, "", "H1", "H2"]), rng.randint(1, 3), " ".join("w" * rng.randint(1, 4) for _ in range(rng.choice([0, 1, 3, 9, 30])))) for _ in range(rng.randint(0, 9))] for d in range(25)}
    flat = [(g, i, page, head, text) for g, blocks in docs.items() for i, (head, page, text) in enumerate(blocks)]
    rng.shuffle(flat)
    got = documents.chunk(spark.createDataFrame(flat, "gazette_id string, pos int, page_no int, heading string, text string"), 8).orderBy("gazette_id", "chunk_no").collect()
    for g, blocks in docs.items():
        own = [r for r in got if r.gazette_id == g]
        assert [(r.text, r.pages, (r.headings or [None])[0]) for r in own] == naive_chunks(blocks, 8)
        assert [r.chunk_no for r in own] == list(range(len(own))) and all(r.embed_text == "\n".join([*r.headings, r.text]) for r in own)


def test_chunks_count_with_the_given_tokenizer(spark):
    blocks = spark.createDataFrame([("g", 0, None, None, "abcd ef gh ijklmnopqrst")], "gazette_id string, pos int, page_no int, heading string, text string")
    got = documents.chunk(blocks, 7, counter=len).orderBy("chunk_no").collect()
    assert [(r.text, r.pages) for r in got] == [("abcd ef", []), ("gh", []), ("ijklmnopqrst", [])]  # one word is always taken


def test_artifacts_round_trip(spark, tmp_path):
    root = str(tmp_path / "store")
    meta = spark.createDataFrame([("g", "g.pdf", "s", 2), ("h", "h.pdf", "t", 1)], schemas.META)
    pages = spark.createDataFrame([("g", 1, "one"), ("g", 2, None), ("h", 1, "x" * 60)], schemas.PAGES)
    tables = spark.createDataFrame([("g", 0, 1, 1, 2, ["a", "b"], [["1", None]], ["t"], None)], schemas.TABLES)
    artifacts.write_artifacts(root, meta, pages, tables)
    artifacts.write_artifacts(root, meta.where("gazette_id = 'g'"), pages.where("gazette_id = 'g' and page_no = 1"), tables)  # g again, h untouched
    got = artifacts.read_artifacts(spark, root)
    assert [sorted(map(tuple, df.select(*want.columns).collect())) for df, want in zip(got, (meta, pages, tables), strict=True)] == [
        sorted(map(tuple, meta.collect())), [("g", 1, "one"), ("h", 1, "x" * 60)], sorted(map(tuple, tables.collect())),
    ]
    assert {r.gazette_id for r in artifacts.complete_gazettes(got[0]).collect()} == {"g", "h"}
    assert [r.page_class for r in artifacts.classify_pages(got[1]).orderBy("gazette_id").collect()] == ["scanned", "digital"]


def test_json_layout(spark, tmp_path):
    for g in ("g", "h x"):
        (tmp_path / g / "pages").mkdir(parents=True)
        (tmp_path / g / "tables").mkdir()
        (tmp_path / g / "meta.json").write_text(json.dumps({"source_filename": f"{g}.pdf", "sha256": "s", "page_count": 1}, indent=1))
        (tmp_path / g / "pages" / "0012.txt").write_text("a\nb")
        (tmp_path / g / "tables" / "t0.json").write_text(json.dumps({"index": 3, "page_no": 12, "n_rows": 1, "n_cols": 1, "header": ["h"], "grid": [["c"]], "extra": 1}))
    meta, pages, tables = artifacts.read_json_layout(spark, str(tmp_path))
    assert sorted(r.gazette_id for r in meta.collect()) == ["g", "h x"] and {tuple(r) for r in pages.collect()} == {("g", 12, "a\nb"), ("h x", 12, "a\nb")}
    assert {(r.gazette_id, r.idx, r.page_no, r.grid[0][0]) for r in tables.collect()} == {("g", 3, 12, "c"), ("h x", 3, 12, "c")}
    assert [df.count() for df in artifacts.read_json_layout(spark, str(tmp_path), "g")] == [1, 1, 1]


def test_page_ranges(spark):
    pages = spark.createDataFrame([("g", i, "") for i in range(1, 9)], schemas.PAGES)
    picked = lambda text: sorted(r.page_no for r in artifacts.page_range(pages, *(artifacts.parse_page_range(text) or (None, None))).collect())
    assert picked("3-5") == [3, 4, 5] and picked("7") == [7] and picked(None) == list(range(1, 9)) and picked("20-30") == []


def test_settings(tmp_path):
    cfg = EngineConfig.from_env({"POLL_INTERVAL_SECONDS": "2", "PREPROCESS_SCANS": "Yes", "OUT_DIR": str(tmp_path / "o"), "ANCHOR_PATTERNS": "a\nb", "HEADER_RATIO": "0.5"})
    assert (cfg.poll_interval_seconds, cfg.preprocess_scans, cfg.anchor_patterns, cfg.header_ratio) == (2.0, True, ("a", "b"), 0.5)
    assert EngineConfig(ocr_engine="ocrmac").ocr_options() == {"engine": "ocrmac"} and EngineConfig().ocr_options()["use_cls"] is False
    with pytest.raises(ValueError):
        EngineConfig(ocr_engine="?").ocr_options()
    assert not EngineConfig(sheet_id="x").sheets_enabled() and EngineConfig(sheet_id="x", sheet_credentials="f").sheets_enabled()


def test_markdown_command(spark, tmp_path, capsys):
    source = tmp_path / "notes.md"
    source.write_text("# keep me\n")
    with pytest.raises(ValueError):
        cli.main(["to-md", str(source)])
    assert source.read_text() == "# keep me\n"
    page = tmp_path / "page.html"
    page.write_text("<html><body><h1>Title</h1><p>Some <b>text</b> &amp; more</p></body></html>")
    assert cli.main(["to-md", str(page), "-o", "-"]) == 0
    assert "# Title" in capsys.readouterr().out
    assert sinks.markdown_target("a/b.html", None) == "a/b.md" and sinks.markdown_target("a.html", "c.md") == "c.md"
