"""Batches, ledger, outbox, inbox and mails.  Extraction is replaced where only the batch counts."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cadastra import schemas
from cadastra.config import EngineConfig
from cadastra.operators import mapping
from cadastra.sources import artifacts
from cadastra.sources.sinks import TableSheet
from cadastra.streaming import pipeline as batches
from cadastra.streaming.ledger import GAZETTES, Ledger, latest_status, newest, pending

ROW = schemas.APPLICATION + ", review_reason string, row_seq struct<span_id: int, table_seq: int, record_id: int>"
ISSUE = f"gazette_id string, notification_no string, reason string, severity string, row struct<{schemas.APPLICATION.replace(' ', ':').replace(',:', ',')}>"


class Mail:
    def __init__(self, broken=False):
        self.sent, self.broken = [], broken

    def send(self, subject, body):
        if self.broken:
            raise OSError("mail is down")
        self.sent.append((subject, body))


class Sheet:
    def __init__(self):
        self.down, self.got = False, {}

    def append(self, kind, rows):
        if self.down:
            raise ConnectionError("sheet is down")
        self.got.setdefault(kind, []).extend(r.asDict() for r in rows.collect())


def row(gazette, sr, hash_):
    values = dict(gazette_id=gazette, sr_no=sr, survey_raw="1/1", village="V", taluka="ponda", decision="yes", confidence=0.9, row_hash=hash_, row_seq=(0, 0, int(sr)))
    return tuple(values.get(c) for c in (*schemas.APPLICATION_COLUMNS, "review_reason", "row_seq"))


@pytest.fixture
def engine(spark, tmp_path, monkeypatch):
    """A pipeline whose extraction gives the listed rows; gazette ``bad`` makes it fail."""
    cfg = EngineConfig(**{f"{n}_dir": f"{tmp_path}/{n}" for n in ("data", "inbox", "processed", "failed", "gazettes", "out", "ledger")})
    rows: list[tuple] = []

    def extract(meta, pages, tables, cfg, transport):
        ids = {r.gazette_id for r in meta.collect()}
        if "bad" in ids:
            raise ValueError("broken gazette")
        df = spark.createDataFrame([r for r in rows if r[0] in ids], ROW)
        plots = df.select("gazette_id", "notification_no", "sr_no", F.lit("1/1").alias("survey_number"), F.lit(False).alias("is_part"), "village", "taluka", F.concat("row_hash", F.lit("p")).alias("row_hash"))
        return {"rows": df, "good": df, "issues": spark.createDataFrame([], ISSUE), "plots": plots}

    monkeypatch.setattr(batches, "extract", extract)

    def run(pipe, ids, batch=None, sha=None):
        meta = spark.createDataFrame([(g, f"{g}.pdf", sha or f"sha-{g}", 1) for g in ids], schemas.META)
        got = pipe.process(meta, spark.createDataFrame([], schemas.PAGES), spark.createDataFrame([], schemas.TABLES), batch)
        return {r.gazette_id: r.asDict() for r in got.collect()}

    return cfg, rows, run


def test_sheet_failure_queues_and_retries(spark, engine):
    cfg, rows, run = engine
    rows += [row("g", "1", "a"), row("g", "2", "b")]
    sheet, mail = Sheet(), Mail()
    pipe = batches.Pipeline(spark, cfg, sheet, mail)
    sheet.down = True
    got = run(pipe, ["g"])["g"]
    assert (got["outcome"], got["rows"], got["plots"]) == ("completed", 2, 2) and sheet.got == {}
    waiting = pending(pipe.ledger.outbox()).collect()
    assert len(waiting) == 4 and {r.attempts for r in waiting} == {1} and "sheet is down" in waiting[0].last_error
    assert [s for s, _ in mail.sent] == ["Gazette 39A — 2 new application(s)"] and "4 record(s) are queued" in mail.sent[0][1]
    sheet.down = False
    assert pipe.sync() == {"plots": None, "rows": None}
    assert len(sheet.got["rows"]) == len(sheet.got["plots"]) == 2 and pending(pipe.ledger.outbox()).count() == 0
    assert pipe.sync() == {}


def test_rows_are_emitted_once_and_copies_skipped(spark, engine):
    cfg, rows, run = engine
    rows += [row("g", "1", "a"), row("h", "1", "a"), row("h", "2", "c")]
    pipe = batches.Pipeline(spark, cfg, Sheet())
    assert run(pipe, ["g"])["g"]["rows"] == 1
    assert run(pipe, ["g"])["g"] == {"gazette_id": "g", "rows": None, "plots": None, "review_issues": None, "outcome": "skipped", "reason": "duplicate"}
    assert run(pipe, ["h"])["h"]["rows"] == 1  # hash a was emitted by g
    assert len(pipe.sheet.got["rows"]) == 2


def test_equal_content_within_a_batch_counts_once(spark, engine):
    cfg, rows, run = engine
    rows += [row("g", "1", "a"), row("h", "1", "b")]
    got = run(batches.Pipeline(spark, cfg), ["h", "g"], sha="same")
    assert {k: (v["outcome"], v["reason"]) for k, v in got.items()} == {"g": ("completed", None), "h": ("skipped", "duplicate")}


def test_a_bad_gazette_fails_alone(spark, engine):
    cfg, rows, run = engine
    ids = ["bad", *(f"g{i}" for i in range(5))]
    rows += [row(g, "1", g) for g in ids]
    mail = Mail()
    pipe = batches.Pipeline(spark, cfg, Sheet(), mail)
    got = run(pipe, ids)
    assert {g: r["outcome"] for g, r in got.items()} == {g: "failed" if g == "bad" else "completed" for g in ids}
    assert "broken gazette" in got["bad"]["reason"] and len(pipe.sheet.got["rows"]) == 5
    state = {r.gazette_id: (r.status, r.error_message) for r in pipe.ledger.gazettes().collect()}
    assert state["bad"][0] == "failed" and state["g0"] == ("completed", None)
    assert ("Gazette 39A — processing failed (bad)", "Gazette bad failed:\n\nbroken gazette") in mail.sent and len(mail.sent) == 6


def test_none_found_mail_and_broken_mail(spark, engine):
    cfg, rows, run = engine
    mail = Mail()
    assert run(batches.Pipeline(spark, cfg, notifier=mail), ["empty"])["empty"]["outcome"] == "completed"
    assert mail.sent[0][0] == "Gazette 39A — no rows found" and mail.sent[0][1].startswith("Gazette: empty\n\nNo 39A")
    assert run(batches.Pipeline(spark, cfg, notifier=Mail(broken=True)), ["other"])["other"]["outcome"] == "completed"


def test_nothing_is_queued_without_a_sheet(spark, engine):
    cfg, rows, run = engine
    rows.append(row("g", "1", "a"))
    pipe = batches.Pipeline(spark, cfg)
    assert run(pipe, ["g"])["g"]["rows"] == 1 and pipe.ledger.outbox().count() == 0 and pipe.sync() == {}


def test_a_ledger_failure_is_not_split(spark, engine, monkeypatch):
    cfg, rows, run = engine
    rows += [row("g", "1", "a"), row("h", "1", "b")]
    pipe = batches.Pipeline(spark, cfg, Sheet())
    monkeypatch.setattr(pipe.ledger, "record", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    assert {r["outcome"] for r in run(pipe, ["g", "h"]).values()} == {"failed"} and pipe.sheet.got == {}


def test_inbox_is_parsed_once_and_moved(spark, engine, tmp_path):
    cfg, rows, run = engine
    (tmp_path / "inbox").mkdir()
    for name, body in (("a.pdf", b"1"), ("b.pdf", b"2"), ("copy.pdf", b"2"), ("note.txt", b"3")):
        (tmp_path / "inbox" / name).write_bytes(body)
    asked = []

    def parse(files):
        asked.append(sorted(r.source_filename for r in files.collect()))
        return files.select("gazette_id", F.lit(1).alias("page_no"), F.lit("text").alias("text")), spark.createDataFrame([], schemas.TABLES)

    pipe = batches.Pipeline(spark, cfg)
    got = pipe.process_inbox(parse).collect()
    assert [r.outcome for r in got] == ["completed"] * 2 and asked == [["a.pdf", "b.pdf"]]
    assert sorted(p.name for p in (tmp_path / "processed").iterdir() if p.suffix == ".pdf") == ["a.pdf", "b.pdf"]
    # the copy's content is completed now: it is not pending any more, and stays
    assert pipe.process_inbox(parse).collect() == [] and asked[1:] in ([], [[]])
    assert sorted(p.name for p in (tmp_path / "inbox").iterdir() if p.suffix in (".pdf", ".txt")) == ["copy.pdf", "note.txt"]
    meta, pages, _ = artifacts.read_artifacts(spark, cfg.gazettes_dir)
    assert meta.count() == 2 and {r.page_count for r in meta.collect()} == {1} and pages.count() == 2


def test_ledger_views(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.gazettes().count() == 0 and pending(ledger.outbox()).count() == 0
    entry = lambda **k: spark.createDataFrame([("s", "g", "f.pdf", k.get("status"), k.get("dir"), k.get("pages"), k.get("error"))], "sha256 string, gazette_id string, source_filename string, status string, artifact_dir string, page_count int, error_message string")
    ledger.set_status("1", entry(status="parsed", dir="d", pages=3), 1)
    ledger.set_status("2", entry(status="failed", error="x"), 2)
    ledger.set_status("2", entry(status="completed"), 9)  # a batch is written once
    got = ledger.gazettes().first()
    assert (got.status, got.artifact_dir, got.page_count, got.error_message) == ("failed", "d", 3, "x")
    ledger.set_status("3", entry(status="processing"), 3)
    ledger.recover("4", 4)
    got = ledger.gazettes().first()
    assert (got.status, got.error_message) == ("failed", "Interrupted while processing")
    assert newest(ledger.gazettes(), "completed").count() == 0 and newest(ledger.gazettes()).count() == 1
    assert latest_status(ledger.read("gazettes", GAZETTES)).count() == 1


def test_table_sheet_appends(spark, tmp_path):
    sheet = TableSheet(str(tmp_path))
    for k in (1, 2):
        sheet.append("rows", spark.createDataFrame([(str(k), None)], "sr_no string, village string"))
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/Rows").collect()) == [("1", None), ("2", None)]


def test_mapper_settings(monkeypatch):
    assert mapping.transport_of(EngineConfig()) is None
    with pytest.raises(ValueError):
        mapping.transport_of(EngineConfig(mapper="other"))
    asked = []

    class Answer:
        def __enter__(self):
            return self

        def __exit__(self, *a):
            return None

        def read(self):
            return json.dumps({"response": "A", "choices": [{"message": {"content": "B"}}]}).encode()

    monkeypatch.setattr("urllib.request.urlopen", lambda request, timeout: asked.append(request) or Answer())
    assert mapping.transport_of(EngineConfig.from_env({"MAPPER": "ollama", "MAPPER_URL": "http://m/", "MAPPER_MODEL": "small"}))("q") == "A"
    assert mapping.transport_of(EngineConfig(mapper="openai_compat", mapper_url="http://m/v1", mapper_key="k"))("q") == "B"
    assert [r.full_url for r in asked] == ["http://m/api/generate", "http://m/v1/chat/completions"]
    assert json.loads(asked[0].data)["model"] == "small" and asked[1].get_header("Authorization") == "Bearer k" and asked[0].get_header("Authorization") is None
