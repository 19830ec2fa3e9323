"""The document pipeline: clean, chunk, tag, filter; tables beside texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import chunking, taxonomy
from tessera.operators.tables import TABLE_HEADING
from tessera.sources import landed
from tessera.sources.sinks import write_records

RECORD = ("ticker", "fiscal_year", "heading_context", "filtered_chunk_text", "token_count", "matched_tags", "chunk_source")


def build(docs: DataFrame, words: list[taxonomy.Keyword], limit: int = T.MAX_TOKENS, threshold: int = taxonomy.THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of (ticker, fiscal_year, raw_text, tables, heading_context, normalize_ocr), and the columns in keep.

    Texts are repaired (if asked), cleaned and chunked; each table sentence is split alone, as it is; what has no tag
    is dropped. Texts come before tables (source_ord), each in document order (chunk_pos). No shuffle.
    """
    key = ("ticker", "fiscal_year", *keep)
    raw = F.coalesce("raw_text", F.lit(""))
    raw = F.when(F.coalesce("normalize_ocr", F.lit(False)), T.repair_ocr(raw)).otherwise(raw)
    texts = docs.select(*key, raw.alias("_raw"), F.coalesce("heading_context", F.lit(T.DEFAULT_HEADING)).alias("_heading"))
    texts = chunking.chunk_rows(texts, "_raw", F.col("_heading"), limit).select(*key, F.lit(0).alias("source_ord"), "chunk_pos", "heading_context", "filtered_chunk_text", "token_count", F.lit("TEXT").alias("chunk_source"))
    rows = docs.select(*key, F.posexplode("tables").alias("_row", "_s")).select(*key, "_row", F.posexplode(chunking.split_column(F.col("_s"), limit)).alias("_i", "_p"))
    rows = rows.select(*key, F.lit(1).alias("source_ord"), (F.col("_row") * 100_000 + F.col("_i")).alias("chunk_pos"), F.lit(TABLE_HEADING).alias("heading_context"), F.col("_p.text").alias("filtered_chunk_text"), F.col("_p.token_count").alias("token_count"), F.lit("TABLE").alias("chunk_source"))
    return taxonomy.tagged(texts.unionByName(rows), "filtered_chunk_text", words, threshold).select(*keep, "source_ord", "chunk_pos", *RECORD)


def from_text(spark: SparkSession, raw_text: str, ticker: str, fiscal_year: int, words: list[taxonomy.Keyword], heading: str = T.DEFAULT_HEADING, normalize_ocr: bool = False, tables: list[str] | None = None) -> DataFrame:
    """Records of one text."""
    row = [(ticker, fiscal_year, raw_text, tables or [], heading, normalize_ocr)]
    return build(spark.createDataFrame(row, "ticker string, fiscal_year int, raw_text string, tables array<string>, heading_context string, normalize_ocr boolean"), words).select(*RECORD)


def process(spark: SparkSession, metadata_path: str, extracted: DataFrame, words: list[taxonomy.Keyword], out: str) -> int:
    """Metadata files joined with what was extracted of their documents (path, raw_text, tables), written as JSON lines; the number of records."""
    meta = landed.metadata(spark, metadata_path)
    docs = meta.join(extracted, meta.absolute_storage_path == extracted.path)
    return write_records(build(docs, words, keep=("path",)), out, RECORD, ("path", "source_ord", "chunk_pos"))


def preview(text: Column, n: int = 90) -> Column:
    return F.substring(text, 1, n)
