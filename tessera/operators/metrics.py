"""Quality metrics, service levels and alerts."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import edits, error_rate

# The service levels (metric, name, threshold, comparison), and the error rate in percent that raises an alert.
LEVELS = [
    ("ocr_cer", "OCR CER", 0.05, "<"),
    ("table_extraction", "Table Extraction", 0.85, ">"),
    ("boundary_error", "Boundary Error", 0.01, "<"),
    ("taxonomy_fp", "Taxonomy FP", 0.10, "<"),
    ("throughput_pps", "Throughput AC+chunking (pages/sec)", 500.0, ">"),
    ("throughput_e2e_pps", "Throughput end-to-end (pages/sec)", 3.0, ">"),
]
ALERT = 15.0


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where there is no whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def counters(rows: DataFrame, outcome: str, kinds: dict[str, str]) -> DataFrame:
    """One row: how many rows have each kind of outcome (name -> value), and how many there are."""
    return rows.agg(*(F.count_if(F.col(outcome) == v).alias(k) for k, v in kinds.items()), F.count("*").alias("total"))


def failure_percent(failed: Column, total: Column) -> Column:
    return ratio(100 * failed, total)


def alerts(rate: Column) -> Column:
    return rate >= ALERT


def corpus_error_rate(pairs: DataFrame, read: str, truth: str) -> DataFrame:
    """One row: all edits over all characters of the truth."""
    rows = pairs.repartition(F.xxhash64(read, truth)).select(F.explode(F.array(edits(F.col(read), F.col(truth)))).alias("e"))  # dealt out, for the work is far more than the bytes
    sums = rows.agg(F.sum("e.edits").alias("edits"), F.sum("e.chars").alias("chars"))
    return sums.select(ratio(F.coalesce("edits", F.lit(0)), F.coalesce("chars", F.lit(0))).alias("corpus_cer"))


def error_rates(pairs: DataFrame, read: str, truth: str) -> DataFrame:
    """pairs, as they are dealt out, with their number of edits, and cer; for long texts the work is far more than the bytes, so few files should be dealt out first."""
    rows = pairs.withColumn("_e", F.explode(F.array(edits(F.col(read), F.col(truth)))))
    rate = F.when(F.col("_e.chars") == 0, F.when(F.col("_e.given") == 0, 0.0).otherwise(1.0)).otherwise(F.col("_e.edits") / F.col("_e.chars"))
    return rows.withColumn("edits", F.col("_e.edits")).withColumn("cer", rate).drop("_e")


def levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEVELS, "metric string, name string, threshold double, comparison string")


def gated(measured: DataFrame, spark: SparkSession) -> DataFrame:
    """(metric, value, passed) of the measurements (metric, value) that have a level; NaN fails."""
    rows = measured.join(F.broadcast(levels(spark)), "metric")  # six rows
    ok = F.when(F.col("comparison") == "<", F.col("value") < F.col("threshold")).otherwise(F.col("value") > F.col("threshold"))
    return rows.select("metric", "value", (ok & ~F.isnan("value")).alias("passed"))


def throughput(run: Callable[[], object], pages: int, repeat: int = 1) -> float:
    """Pages a second of wall time; 0.0 without pages, infinite if no time went by."""
    if not pages:
        return 0.0
    began = time.perf_counter()
    for _ in range(repeat):
        run()
    took = time.perf_counter() - began
    return pages * repeat / took if took > 0 else float("inf")
