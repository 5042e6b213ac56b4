"""Command line: run, watch, extract, to-md, sync, status, chunk."""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from cadastra.config import EngineConfig
from cadastra.operators import documents, mapping
from cadastra.plans.extract import extract
from cadastra.sources import artifacts, html, sinks
from cadastra.streaming.ledger import Ledger, newest
from cadastra.streaming.pipeline import Pipeline


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="cadastra")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "watch", "sync", "status"):
        sub.add_parser(name)
    for name in ("extract", "chunk"):
        c = sub.add_parser(name)
        c.add_argument("gazette_id")
        if name == "chunk":
            c.add_argument("--max-tokens", type=int, default=512)
    md = sub.add_parser("to-md")
    md.add_argument("file")
    md.add_argument("-o", "--output")
    md.add_argument("--pages")
    args = p.parse_args(argv)
    cfg = EngineConfig.from_env()
    spark = SparkSession.builder.appName("cadastra").getOrCreate()
    if args.command in ("run", "watch"):
        cfg.make_dirs()
        pipe = Pipeline(spark, cfg)
        while True:
            pipe.process(*artifacts.read_json_layout(spark, cfg.gazettes_dir)).show(truncate=False)
            if args.command == "run":
                break
            time.sleep(cfg.poll_interval_seconds)
    elif args.command == "extract":
        found = extract(*artifacts.read_json_layout(spark, cfg.gazettes_dir, args.gazette_id), cfg, mapping.transport_of(cfg))
        found["rows"].show(1000, truncate=False)
        found["plots"].show(1000, truncate=False)
    elif args.command == "chunk":
        _, pages, _ = artifacts.read_json_layout(spark, cfg.gazettes_dir, args.gazette_id)
        blocks = pages.selectExpr("gazette_id", "page_no as pos", "page_no", "cast(null as string) as heading", "text")
        documents.chunk(blocks, args.max_tokens).show(1000, truncate=False)
    elif args.command == "to-md":
        target = sinks.markdown_target(args.file, args.output)
        pages = html.read_any(spark, args.file)
        text = documents.to_markdown(pages, "path")
        if target is None:
            for row in text.toLocalIterator():
                sys.stdout.write(row.markdown)
        else:
            sinks.write_markdown(text, target)
    elif args.command == "sync":
        errors = Pipeline(spark, cfg, sinks.TableSheet(f"{cfg.out_dir}/sheet")).sync()
        return int(any(errors.values()))
    else:
        newest(Ledger(spark, cfg.ledger_dir).gazettes()).show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
