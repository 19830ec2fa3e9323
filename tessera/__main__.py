"""Command line: python -m tessera demo | process METADATA [-o OUT] [--extracted PARQUET] [--taxonomy JSON] | rss NAME=PATH... [--seen PATH]."""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from tessera.operators import taxonomy
from tessera.plans import records, runs

# The text of the demonstration, its issuer and heading.
DEMO = ("Cng ty huong toi N3t Zer0.\n\nTong luong phat thai CO2 nam 2023 la 1500 tan.", "VNM", 2023, "Bao cao Moi truong")


def _words(spark: SparkSession, path: str | None) -> list[taxonomy.Keyword]:
    return taxonomy.load(spark, path) if path else taxonomy.keywords(taxonomy.ESG)


def demo(spark: SparkSession, args: argparse.Namespace) -> None:
    text, ticker, year, heading = DEMO
    for row in records.from_text(spark, text, ticker, year, _words(spark, args.taxonomy), heading, normalize_ocr=True).collect():
        print(json.dumps(row.asDict(), ensure_ascii=False))


def process(spark: SparkSession, args: argparse.Namespace) -> None:
    n = records.process(spark, args.metadata, spark.read.parquet(args.extracted), _words(spark, args.taxonomy), args.output)
    print(f"Wrote {n} records to {args.output}")


def rss(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"{runs.rss(spark, dict(x.split('=', 1) for x in args.feeds), args.seen)} new items")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessera", description=__doc__)
    top.add_argument("--taxonomy", help="a JSON file of categories; the built-in one if not given")
    sub = top.add_subparsers(dest="command", required=True)
    sub.add_parser("demo", help="records of a sample text").set_defaults(run=demo)
    p = sub.add_parser("process", help="records of documents, from their metadata and what was extracted of them")
    p.add_argument("metadata")
    p.add_argument("-o", "--output", default="./out")
    p.add_argument("--extracted", required=True, help="Parquet of path, raw_text, tables")
    p.set_defaults(run=process)
    p = sub.add_parser("rss", help="poll landed feeds once")
    p.add_argument("feeds", nargs="+", metavar="NAME=PATH")
    p.add_argument("--seen", default="./seen", help="Parquet of the contents seen so far")
    p.set_defaults(run=rss)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s", stream=sys.stderr)
    args.run(spark or SparkSession.builder.appName("tessera").getOrCreate(), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
