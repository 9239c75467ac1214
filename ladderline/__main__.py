"""python -m ladderline: process a capture folder, or look into a table."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from .sources import process
from .sources.dataset import TABLES, peek


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ladderline", description=__doc__)
    what = p.add_mutually_exclusive_group(required=True)
    what.add_argument("--in", dest="source", help="capture folder: <ticker>/<channel>/<day>.jsonl")
    what.add_argument("--head", help="table to look into: schema, number of rows, first rows as JSON")
    p.add_argument("--tickers", help="comma-separated; all that the capture has, if absent")
    p.add_argument("--out", help="folder of the tables; <in>_processed if absent")
    p.add_argument("--new", action="store_true", help="process only tickers whose files changed since the last run, and keep the tables of the others")
    p.add_argument("--format", choices=("parquet", "feather"), default="parquet", help="feather writes a folder of Arrow files for each table beside the Parquet tables")
    p.add_argument("--rows", type=int, default=5)
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.head:
        schema, n, rows = peek(spark, a.head, a.rows)
        print(schema, f"{n} rows", *rows, sep="\n")
        return 0
    source = a.source.rstrip("/")
    out = a.out or f"{source}_processed"
    if a.new and a.tickers:
        p.error("--new finds the tickers itself")
    manifest = process.process_new(spark, source, out) if a.new else process.process_capture(spark, source, out, a.tickers.split(",") if a.tickers else None)
    for r in manifest.orderBy("ticker").toLocalIterator():
        print(process.pretty(r))
    if a.format == "feather":
        for name in TABLES:
            process.write_feather(spark.read.schema(TABLES[name]).parquet(f"{out}/{name}"), os.path.join(out, f"{name}.feather"))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
