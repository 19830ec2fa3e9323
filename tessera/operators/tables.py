"""Extracted tables as grids of cells (ARRAY<ARRAY<STRING>>), flattened to sentences; OCR words to pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import strip

# Least accuracy of a ruled table, least confidence of an OCR word, what marks a page header.
ACCURACY, CONFIDENCE, PAGE_MARK = 80.0, 60, "Page"
TABLE_HEADING = "Bang du lieu"


def flatten(grid: Column) -> Column:
    """A sentence "header: cell | header: cell" for each row below the first; empty cells and rows are left out, and a longer row ends with its headers."""
    header = F.transform(F.element_at(grid, 1), lambda c: strip(F.coalesce(c, F.lit(""))))

    def sentence(row):
        n = F.least(F.size(header), F.size(row))
        pairs = F.zip_with(F.slice(header, F.lit(1), n), F.slice(row, F.lit(1), n), lambda h, c: F.when(strip(F.coalesce(c, F.lit(""))) != "", F.concat(h, F.lit(": "), strip(c))))
        return F.array_join(F.array_compact(pairs), " | ")

    body = F.when(F.size(grid) > 1, F.slice(grid, F.lit(2), F.size(grid) - 1)).otherwise(F.slice(grid, 1, 0))
    return F.filter(F.transform(body, sentence), lambda s: s != "")


def pick(ruled: DataFrame, plain: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """Of each document the accurate ruled tables, or else the plain ones without page headers; all of two columns or more."""
    good = ruled.filter((F.col("accuracy") > ACCURACY) & (F.size("grid") > 0))
    rest = plain.join(good.select(doc_col).distinct(), doc_col, "left_anti").filter(~F.exists(F.element_at("grid", 1), lambda h: F.contains(F.coalesce(h, F.lit("")), F.lit(PAGE_MARK))))
    return good.unionByName(rest, allowMissingColumns=True).filter(F.size(F.element_at("grid", 1)) >= 2)


def confident(conf: Column) -> Column:
    """Whole-number confidence over the least; what isn't a number counts as -1."""
    return F.coalesce(F.when(conf.try_cast("double").isNotNull() & ~F.isnan(conf.try_cast("double")), F.floor(F.abs(conf.try_cast("double"))) * F.signum(conf.try_cast("double"))), F.lit(-1)) > CONFIDENCE


def ocr_text(words: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """(doc, raw_text) from (doc, page, pos, text, conf): confident words that aren't blank, spaces within a page, a line feed between pages."""
    kept = words.filter(confident(F.col("conf")) & (strip(F.col("text")) != ""))
    pages = kept.groupBy(doc_col, "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x.text), " ").alias("text"))
    return pages.groupBy(doc_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x.text), "\n").alias("raw_text"))
