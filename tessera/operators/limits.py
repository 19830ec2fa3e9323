"""Rate limits and quotas: fixed windows that start with a key's first call."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import ordered
from tessera.sources.shared import cut

DAY = 86_400
#: Where calls without a time stand.
_UNTIMED = -(1 << 62)


def windows(calls: DataFrame, key: str, time: str, tie: str, seconds: int, hot: int = ordered.HOT) -> DataFrame:
    """(key, t, tie, n): each call's number within its window, refused calls included; calls without a time come first, in a window of their own.

    A window starts with the first call after the one before has ended, so its start depends on all earlier ones. Keys
    of fewer than `hot` calls pass by in order, one task a key; the others are split, and their starts are found by
    pointer jumping.
    """
    rows = calls.select(F.col(key).alias("key"), F.unix_micros(F.col(time).cast("timestamp")).alias("us"), F.col(tie).alias("tie"))
    large = rows.groupBy("key").count().filter(F.col("count") >= hot).select(F.col("key").alias("_hot"))
    if large.isEmpty():
        out = _passed(rows, seconds)
    else:
        same = F.col("key").eqNullSafe(F.col("_hot"))
        out = _passed(rows.join(large, same, "left_anti"), seconds).unionByName(jumped(rows.join(large, same, "left_semi"), seconds))
    return out.select(F.col("key").alias(key), F.timestamp_micros("us").alias("t"), "tie", "n")


def jumped(rows: DataFrame, seconds: int) -> DataFrame:
    """(key, us, tie, n) of rows (key, us, tie) in which a key may be of any size.

    Each call time points to the first one a window later. The first is a start, and so is what a start points to: with
    each round the starts take the pointers as they are, and the pointers are joined with themselves, so that they lead
    twice as far. The number of rounds is the logarithm of the number of windows of a key.
    """
    early = F.coalesce("us", F.lit(_UNTIMED))
    placed = ordered.ranked(rows, [F.col("key"), F.col("us").asc_nulls_first(), F.col("tie")], out="place").withColumn("at", early)
    nodes = placed.groupBy("key", "at").agg(F.min("place").alias("place"))
    to = ordered.asof(nodes.select("key", "place", (F.col("at") + seconds * 1_000_000).alias("at")), nodes.withColumnRenamed("place", "next"), ["key"], "at", ["next"], forward=True)
    jump = cut(to.filter("next is not null").select("place", "next"))
    starts = cut(nodes.groupBy("key").agg(F.min("place").alias("place")).select("place"))
    while not jump.isEmpty():
        starts = cut(starts.unionByName(jump.join(starts, "place", "left_semi").select(F.col("next").alias("place"))).distinct())
        on = jump.select(F.col("place").alias("next"), F.col("next").alias("after"))
        jump = cut(jump.join(on, "next").select("place", F.col("after").alias("next")))
    flagged = placed.join(starts.select(F.col("place").alias("start")), F.col("place") == F.col("start"), "left")
    held = ordered.running(flagged, ["key"], [F.col("place")], {"since": ("max", F.col("start"))}, inclusive=True, hot=0)
    return held.select("key", "us", "tie", (F.col("place") - F.col("since") + 1).cast("int").alias("n"))


def _passed(rows: DataFrame, seconds: int) -> DataFrame:
    """(key, us, tie, n): each key's calls pass by in order, and all that is kept of them is the window's start and count. Sorting may spill; a window is found by bisection, so a long one costs no more than a short one."""
    rows = rows.repartition("key").sortWithinPartitions("key", "us", "tie").withColumn("group", F.xxhash64("key"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "group")
    span = seconds * 1_000_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = last = start = None
        n = 0
        for batch in batches:
            group, us = batch.column(3).to_numpy(), pc.fill_null(batch.column(1), _UNTIMED).to_numpy()
            keys, out = batch.column(0), np.zeros(len(us), np.int32)
            cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if held is None or group[a] != held or keys[a] != last:
                    held, last, start, n = group[a], keys[a], None, 0
                at = a
                while at < b:
                    if start is None or us[at] - start >= span:
                        start, n = int(us[at]), 0
                    end = at + int(np.searchsorted(us[at:b], start + span, "left"))
                    out[at:end] = n + np.arange(1, end - at + 1)
                    n += end - at
                    at = end
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out)], ["key", "us", "tie", "n"])

    return rows.mapInArrow(run, f"{kinds}, n int")


def rate_limited(calls: DataFrame, key: str, time: str, tie: str, limit: int, seconds: int, hot: int = ordered.HOT) -> DataFrame:
    return windows(calls, key, time, tie, seconds, hot).withColumn("allowed", F.col("n") <= limit)


def quota(calls: DataFrame, key: str, time: str, tie: str, daily: int, hot: int = ordered.HOT) -> DataFrame:
    """What is left after each call; below zero it is exhausted."""
    return windows(calls, key, time, tie, DAY, hot).withColumn("remaining", daily - F.col("n")).withColumn("exhausted", F.col("remaining") < 0)
