"""Readers of landed inputs; every schema is explicit, so nothing is scanned to infer one."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import DEFAULT_HEADING
from tessera.sources.errors import FallbackUnavailable

METADATA = "absolute_storage_path string, ticker string, fiscal_year int, heading_context string, pdf_type_flag string, normalize_ocr boolean"
BARS = "symbol string, time timestamp, open double, high double, low double, close double, volume bigint"
OVERVIEW = "symbol string, issue_share string"
REPORT = "ticker string, year int, metric string, value double"
ITEM = "title string, link string, pubDate string, summary string, description string"
NEWS = "source string, title string, link string, published string, body_text string"
DOCUMENTS = "doc_id string, ticker string, fiscal_year int, storage_path string, pdf_type_flag string, content_hash string, state string, error_message string, updated_at timestamp"
# The feeds read by default.
FEEDS = {"CafeF - Doanh nghiep": "https://cafef.vn/tin-kinh-te-vi-mo.rss", "Vietstock - Doanh nghiep": "https://vietstock.vn/rss/doanh-nghiep.rss"}

T = TypeVar("T")


def retried(read: Callable[[], T], attempts: int = 3, least: float = 2, most: float = 10, sleep: Callable[[float], None] = time.sleep, final: tuple[type[Exception], ...] = ()) -> T:
    """read(), tried again after waits that double from least to most seconds; the last error is raised, and one in `final` at once."""
    for n in range(attempts):
        try:
            return read()
        except Exception as e:
            if n + 1 == attempts or isinstance(e, final):
                raise
            sleep(min(most, least * 2**n))
    raise ValueError("no attempts")


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Document metadata files; the heading and the OCR repair have their defaults (repair for scans)."""
    rows = spark.read.schema(METADATA).option("multiLine", True).json(path)
    scanned = F.col("pdf_type_flag") == "SCAN_BASED"
    return rows.withColumn("heading_context", F.coalesce("heading_context", F.lit(DEFAULT_HEADING))).withColumn("normalize_ocr", F.coalesce("normalize_ocr", scanned, F.lit(False)))


def bars(spark: SparkSession, path: str, symbol: str | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Price bars of landed Parquet, with the issuer and the period pushed down to the scan."""
    rows = spark.read.schema(BARS).parquet(path)
    if symbol:
        rows = rows.filter(F.col("symbol") == symbol)
    if start:
        rows = rows.filter(F.col("time") >= F.lit(start).cast("timestamp"))
    if end:
        rows = rows.filter(F.col("time") <= F.lit(end).cast("timestamp"))
    return rows


def statement(spark: SparkSession, path: str) -> DataFrame:
    """A wide statement: symbol, item_en and a column for each year (found in the files' own schema)."""
    return spark.read.parquet(path)


def overview(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OVERVIEW).parquet(path)


def financial_report(spark: SparkSession, read: Callable[[str, int], DataFrame], root: str, ticker: str, year: int) -> DataFrame:
    """read(ticker, year), or if that fails {root}/financials/{ticker}_{year}.csv. A missing year is not a failure."""
    try:
        return read(ticker, year)
    except Exception as e:
        try:
            return spark.read.schema(REPORT).option("header", True).csv(f"{root}/financials/{ticker}_{year}.csv")
        except AnalysisException:
            raise FallbackUnavailable(f"{ticker} {year}") from e


def feed(spark: SparkSession, source: str, path: str) -> DataFrame:
    """The items of an RSS file; the body is the summary or else the description, markup and all; missing fields are empty."""
    rows = spark.read.format("xml").option("rowTag", "item").schema(ITEM).load(path)
    empty = lambda c: F.coalesce(c, F.lit(""))
    body = F.coalesce(F.nullif(F.col("summary"), F.lit("")), F.nullif(F.col("description"), F.lit("")), F.lit(""))
    return rows.select(F.lit(source).alias("source"), empty("title").alias("title"), empty("link").alias("link"), empty("pubDate").alias("published"), body.alias("body_text"))


def united(sources: dict[str, DataFrame]) -> DataFrame:
    """The rows of all sources, each with the name of its own in the column source."""
    out = None
    for name, rows in sources.items():
        rows = rows.withColumn("source", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def feeds(spark: SparkSession, paths: dict[str, str], failed: Callable[[str, Exception], None] | None = None) -> DataFrame:
    """All feeds' items; a feed that can't be read is reported and left out."""
    out = spark.createDataFrame([], NEWS)
    for source, path in paths.items():
        try:
            out = out.unionByName(feed(spark, source, path))
        except AnalysisException as e:
            if failed:
                failed(source, e)
    return out


def stored(spark: SparkSession, url: str, table: str = "documents") -> DataFrame:
    """The documents table of a database (postgres or sqlite, through its JDBC driver) or of a path."""
    for scheme, driver in (("postgresql://", "postgresql"), ("postgres://", "postgresql"), ("sqlite:///", "sqlite")):
        if url.startswith(scheme):
            rest = url[len(scheme) :]
            return spark.read.format("jdbc").option("url", f"jdbc:{driver}:{'' if driver == 'sqlite' else '//'}{rest}").option("dbtable", table).load()
    if "://" in url and not url.startswith(("file://", "s3a://", "hdfs://", "viewfs://")):
        raise ValueError(f"no reader for {url}")
    return spark.read.schema(DOCUMENTS).parquet(url)
