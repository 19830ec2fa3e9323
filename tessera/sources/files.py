"""Binary documents: landed files, their checks, and pluggable extractors; names and paths that can't escape."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.errors import ExtractorMissing

# The largest file, how a PDF starts, and the pages that table extractors read by default.
MAX_BYTES, MAGIC = 100 * 1024 * 1024, b"%PDF-"
EXTRACTED = "path string, raw_text string, tables array<string>, error string"


def binary(spark: SparkSession, path: str, pattern: str = "*", max_bytes: int = MAX_BYTES) -> DataFrame:
    """(path, length, content) of files up to max_bytes; larger ones are left out by their length, before they're read: see oversize()."""
    return _landed(spark, path, pattern).filter(F.col("length") <= max_bytes).select("path", "length", "content")


def oversize(spark: SparkSession, path: str, pattern: str = "*", max_bytes: int = MAX_BYTES) -> DataFrame:
    """(path, error) of the files that binary() leaves out, for the rejects; their content isn't read."""
    return _landed(spark, path, pattern).filter(F.col("length") > max_bytes).select("path", F.format_string(f"%d bytes, more than {max_bytes}", "length").alias("error"))


def _landed(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)


def is_pdf(content: Column) -> Column:
    return F.coalesce(F.substring(content, 1, len(MAGIC)) == F.lit(MAGIC), F.lit(False))


def checked(files: DataFrame, expect_pdf: bool = True, clean: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad): files with sha256, and the rejects with a reason. `clean` is a malware scan as a boolean expression; without one all pass."""
    why = F.when(F.lit(expect_pdf) & ~is_pdf(F.col("content")), "not a PDF")
    if clean:
        why = F.coalesce(F.when(~clean(F.col("content")), "malware"), why)
    rows = files.withColumn("sha256", F.sha2("content", 256)).withColumn("error", why)
    return rows.filter("error is null").drop("error"), rows.filter("error is not null").select("path", "error")


def extracted(files: DataFrame, text: Callable[[bytes], tuple[str, list[str]]] | None = None, scan: Callable[[bytes], tuple[str, list[str]]] | None = None) -> DataFrame:
    """(path, raw_text, tables, error) from (path, content, pdf_type_flag): scans go to `scan`, others to `text`; an extractor's failure is a row with its error, and no failure of the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content, flag in zip(batch["path"], batch["content"], batch["pdf_type_flag"], strict=True):
                use = scan if flag == "SCAN_BASED" else text
                if use is None:
                    raise ExtractorMissing(f"no extractor for {flag}")
                try:
                    raw, tables = use(content)
                    out.append((path, raw, list(tables), None))
                except Exception as e:
                    out.append((path, None, [], f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "raw_text", "tables", "error"])

    return files.select("path", "content", "pdf_type_flag").mapInPandas(run, EXTRACTED)


def saved(files: DataFrame, base: str) -> DataFrame:
    """(path, length) of files (folder, name, content), each written under base, a folder that the executors share, by a safe name; a file is there whole or not at all, and writing it again replaces it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for folder, name, content in zip(batch["folder"], batch["name"], batch["content"], strict=True):
                to = safe_join(base, folder, name)
                os.makedirs(os.path.dirname(to), exist_ok=True)
                staged = f"{to}.{uuid.uuid4().hex}"
                with open(staged, "wb") as f:
                    f.write(content)
                os.replace(staged, to)
                out.append((to, len(content)))
            yield pd.DataFrame(out, columns=["path", "length"])

    return files.select("folder", safe_name(F.col("name")).alias("name"), "content").mapInPandas(run, "path string, length bigint")


def joined_pages(pages: DataFrame, key: str, separator: str = "\n\n", most: int | None = None) -> DataFrame:
    """(key, raw_text) from (key, page, text), pages up to `most`."""
    if most:
        pages = pages.filter(F.col("page") <= most)
    return pages.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x.text), separator).alias("raw_text"))


def safe_name(name: Column) -> Column:
    """The last part of a path, of letters, digits, dots, lines and hyphens, with _ for spaces; "unnamed" if nothing is left."""
    kept = F.trim(F.regexp_replace(F.replace(F.regexp_extract(name, r"([^/]*)$", 1), F.lit(".."), F.lit("")), r"[^\p{L}\p{N}._\- ]", ""))
    return F.when(kept == "", "unnamed").otherwise(F.replace(kept, F.lit(" "), F.lit("_")))


def safe_join(base: str, *parts: str) -> str:
    """A path under base, or ValueError."""
    root = os.path.abspath(base)
    path = os.path.abspath(os.path.join(root, *parts))
    if os.path.commonpath([root, path]) != root:
        raise ValueError(f"outside of {base}: {parts}")
    return path
