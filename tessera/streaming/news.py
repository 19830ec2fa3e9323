"""Structured Streaming forms of news deduplication, and running a stream over what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.dedup import hashed
from tessera.sources.keyed import KeyedTable
from tessera.streaming.state import PROVIDER


def items(spark: SparkSession, path: str, schema: str, per_trigger: int | None = None) -> DataFrame:
    """A stream of the Parquet files that land in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).parquet(path)


def new_items(stream: DataFrame, text_col: str, within: tuple[str, str] | None = None) -> DataFrame:
    """Items whose content hash is new. The state keeps every hash, as the batch form does; within=(time column, delay) bounds it by a watermark instead."""
    rows = hashed(stream, text_col)
    if within:
        return rows.withWatermark(*within).dropDuplicatesWithinWatermark(["content_hash"])
    return rows.dropDuplicates(["content_hash"])


def into_table(stream: DataFrame, table: KeyedTable, checkpoint: str) -> None:
    """Runs the stream over all that has landed, into the table: of each key that it doesn't hold yet a trigger's first row (by its other columns). A batch that comes again adds nothing, so a run that died is simply run again."""
    columns = [f.name for f in table.schema if f.name in stream.columns and f.name != table.key]

    def add(rows: DataFrame, _: int) -> None:
        first = rows.groupBy(table.key).agg(F.min(F.struct(*columns)).alias("_r")).select(table.key, "_r.*")
        table.upsert(first.join(table.read().select(table.key), table.key, "left_anti"))

    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def drained(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs the stream over all that has landed, into Parquet at path, and reads that; run again, it takes up what is new."""
    conf = stream.sparkSession.conf
    before = {k: conf.get(k, None) for k in PROVIDER}
    for k, v in PROVIDER.items():
        conf.set(k, v)
    try:
        _run(stream, path, checkpoint, mode)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    return stream.sparkSession.read.parquet(path)


def _run(stream: DataFrame, path: str, checkpoint: str, mode: str) -> None:
    stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
