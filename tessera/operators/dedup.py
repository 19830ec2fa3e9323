"""Exact deduplication of news and files by content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField

from tessera.functions.text import content_hash


def _named(field: StructField) -> Column:
    return F.col("`" + field.name.replace("`", "``") + "`")


def hashed(items: DataFrame, text_col: str) -> DataFrame:
    """items with their content hash, which is never null (and said not to be, or a join would hash once more to see)."""
    return items.withColumn("content_hash", F.coalesce(content_hash(F.coalesce(F.col(text_col), F.lit(""))), F.lit("")))


def new_items(items: DataFrame, text_col: str, order_col: str, seen: DataFrame | None = None) -> DataFrame:
    """The first item (by order_col, nulls last; of ties the one of the least row hash) of each hash that `seen` (content_hash) doesn't hold.

    The winners are found on hashes and order alone, with map-side combination, so a hash that a third of all rows
    share neither meets in one task nor carries its texts through the shuffle.
    """
    place = F.struct(F.col(order_col).isNull().alias("late"), F.col(order_col).alias("order"), F.xxhash64(*(F.map_entries(_named(f)) if isinstance(f.dataType, MapType) else _named(f) for f in items.schema)).alias("tie"))
    rows = hashed(items, text_col).withColumn("_place", place)
    first = rows.groupBy("content_hash").agg(F.min("_place").alias("_first"))
    if seen is not None:
        first = first.join(seen.select("content_hash").distinct(), "content_hash", "left_anti")
    first = first.select(F.col("content_hash").alias("_hash"), "_first")
    won = rows.join(first, (F.col("content_hash") == F.col("_hash")) & F.col("_place").eqNullSafe(F.col("_first")))
    return won.drop("_hash", "_first", "_place").dropDuplicates(["content_hash"])  # rows that are alike in all columns


def find_by_hash(keys: DataFrame, stored: DataFrame, hash_col: str, id_col: str) -> DataFrame:
    """keys with the smallest stored id of the same hash, or null."""
    known = stored.groupBy(F.col(hash_col).alias("_hash")).agg(F.min(id_col).alias("found_id"))
    return keys.join(known, F.col(hash_col) == F.col("_hash"), "left").drop("_hash")
