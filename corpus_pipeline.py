"""The corpus pipeline: five stages from raw documents to token ids, each over all that the one before kept.

In every stage a null or empty text is a document without words, which is kept and left as it is; a row with a null id is
kept, and is no copy of any other; rows that repeat an id and a text are one document, and stay or go together, while
rows that share an id alone are documents of their own; an empty table gives an empty one; all columns but the text and
n_chars pass through, whatever their names (in the last stage one named like a new column gives way to it).
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, linededup, minhash, toxicity
from tessera.llm._spark import cut
from tessera.llm.queries import CATEGORIES


def _measured(docs: DataFrame) -> DataFrame:
    """docs, with n_chars, if they have it, as the texts are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def _any_names(stage):
    """stage, which sees plain names for all columns but those it works on."""

    @functools.wraps(stage)
    def named(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = [c if c in ("doc_id", "text", "n_chars") else f"c{i}" for i, c in enumerate(docs.columns)]
        out = stage(spark, docs.toDF(*plain), sf_dir)
        back = dict(zip(plain, docs.columns, strict=True))
        new = [c for c in out.columns if c not in back]
        keep = [c for c in out.columns if c in new or back[c] not in new]
        return out.select(*keep).toDF(*(back.get(c, c) for c in keep))

    return named


@_any_names
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the chain rejects; without labelled documents none is."""
    return toxicity.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), CATEGORIES, "toxic")


@_any_names
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that match an earlier one; a document of such lines alone goes."""
    return _measured(linededup.rewrite(docs))


@_any_names
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies (shingles of five words, 0.8 or more); documents that share an id come after all others, in the order of their texts' hashes."""
    h = F.xxhash64("text")
    several = docs.select("doc_id", h.alias("h")).groupBy(F.col("doc_id").alias("of")).agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("of")
    own = docs.join(several, docs["doc_id"] == several["of"], "left")
    own = own.withColumn("node", F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(F.lit(1 << 62) + F.shiftrightunsigned(h, 2))).drop("of")
    gone = minhash.near_duplicates(own, "node").filter(~F.col("kept")).select(F.col("doc_id").alias("gone_node")).distinct()
    return own.join(gone, F.col("node") == F.col("gone_node"), "left_anti").drop("node")


@_any_names
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the spans that occur in benchmark items; a document of which they're more than half goes."""
    return _measured(decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


@_any_names
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, the text decoded from them, and all other columns."""
    keep = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=keep)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("near-dedup", drop_near_copies), ("decontamination", drop_benchmark), ("encoding", encode)]

#: The models of the first stage can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over sf_dir's documents; what a stage keeps is held in shared storage for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
