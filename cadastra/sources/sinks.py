"""Sinks: run files, Markdown, tabs of a sheet, notifications."""

from __future__ import annotations

import os
import uuid
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra import schemas


class OutputSink(Protocol):
    def append_rows(self, rows: DataFrame, plots: DataFrame, issues: DataFrame) -> int: ...


class Notifier(Protocol):
    def send(self, subject: str, body: str) -> None: ...


class FileSink:
    """JSON of rows, plots and review and CSV of rows below one directory per run.  The run id is
    unique; writing a run again replaces it.  Nothing is written when there is nothing."""

    def __init__(self, out_dir: str):
        self.out_dir = out_dir

    def append_rows(self, rows: DataFrame, plots: DataFrame, issues: DataFrame, run_id: str | None = None) -> int:
        n = rows.count()
        any_issue = not issues.isEmpty()
        if not n and not any_issue:
            return 0
        base = f"{self.out_dir}/run_{run_id or uuid.uuid4().hex}"
        out = rows.select(*schemas.APPLICATION_COLUMNS)
        json = lambda df, name: df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{base}.{name}.json")
        if n:
            json(out, "rows")
            out.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(f"{base}.rows.csv")
        if not plots.isEmpty():
            json(plots, "plots")
        if any_issue:
            json(issues.select("reason", "severity", "row"), "review")
        return n


def write_markdown(markdown: DataFrame, path: str) -> None:
    markdown.select(F.col("markdown").alias("value")).write.mode("overwrite").text(path)


def markdown_target(source: str, output: str | None) -> str | None:
    """Where to write the Markdown of ``source``: beside it by default, None for '-' (stdout); the
    source itself is refused."""
    if output == "-":
        return None
    target = output or os.path.splitext(source)[0] + ".md"
    if os.path.abspath(target) == os.path.abspath(source):
        raise ValueError("output would overwrite the input")
    return target


class TableSheet:
    """A sheet kept as Parquet, one directory per tab: the offline stand-in for a hosted sheet."""

    def __init__(self, root: str, tabs: dict[str, str] | None = None):
        self.root, self.tabs = root, tabs or {"rows": "Rows", "plots": "Plots", "review": "Review"}

    def append(self, kind: str, records: DataFrame) -> None:
        records.write.mode("append").parquet(f"{self.root}/{self.tabs[kind]}")


class MailNotifier:
    """Sends digests by SMTP; without a host it keeps silent."""

    def __init__(self, host: str | None = None, port: int = 587, user: str | None = None, password: str | None = None, sender: str = "", to: str = ""):
        self.host, self.port, self.user, self.password, self.sender, self.to = host, port, user, password, sender, to

    def send(self, subject: str, body: str) -> None:
        if not self.host:
            return
        import smtplib
        from email.message import EmailMessage

        mail = EmailMessage()
        mail["Subject"], mail["From"], mail["To"] = subject, self.sender, self.to
        mail.set_content(body)
        with smtplib.SMTP(self.host, self.port) as smtp:
            smtp.starttls()
            if self.user:
                smtp.login(self.user, self.password or "")
            smtp.send_message(mail)
