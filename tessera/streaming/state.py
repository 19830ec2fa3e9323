"""Keyed state in streams: each key has typed values of its own, which timers remove when their time has come.

The state lies in RocksDB and in the stream's checkpoint, so it's no larger in memory than what a trigger touches, and a
restart takes it up again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tessera.operators.lifecycle import ERROR, STATES

#: The state store that typed state needs.
PROVIDER = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Limiter(StatefulProcessor):
    """Calls of a key in fixed windows that start with the first call after the one before has ended; a trigger's calls in order of time. Once the watermark has passed a window's end, the key is forgotten."""

    def __init__(self, limit: int, seconds: int):
        self.limit, self.span = limit, seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "start bigint, n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        us = np.sort(np.concatenate([b["us"].to_numpy(np.int64) for b in rows]))  # eight bytes a call
        start, n = self.window.get() if self.window.exists() else (None, 0)
        at, count = 0, np.zeros(len(us), np.int32)
        while at < len(us):
            if start is None or us[at] - start >= self.span:
                start, n = int(us[at]), 0
            end = at + int(np.searchsorted(us[at:], start + self.span, "left"))
            count[at:end] = n + np.arange(1, end - at + 1)
            n += end - at
            at = end
        self.window.update((start, n))
        self.handle.registerTimer((start + self.span) // 1000)
        yield pd.DataFrame({"key": [key[0]] * len(us), "us": us, "n": count, "allowed": count <= self.limit})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.window.exists() and self.window.get()[0] + self.span <= expiredTimerInfo.getExpiryTimeInMs() * 1000 + 999:
            self.window.clear()
        return iter(())

    def close(self) -> None:
        pass


def rate_limited(stream: DataFrame, key: str, time: str, limit: int, seconds: int, delay: str = "1 hour") -> DataFrame:
    """(key, t, n, allowed) for each call; calls up to `delay` late are waited for before a key is forgotten."""
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), F.col(time).cast("timestamp").alias("t")).withWatermark("t", delay).withColumn("us", F.unix_micros("t"))
    out = rows.groupBy("key").transformWithStateInPandas(Limiter(limit, seconds), f"key {kind}, us bigint, n int, allowed boolean", "Append", "EventTime")
    return out.select("key", F.timestamp_micros("us").alias("t"), "n", "allowed")


class Lifecycle(StatefulProcessor):
    """The state that each document is in; a trigger's events in order of seq and then state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.now = handle.getValueState("now", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, out = self.now.get()[0] if self.now.exists() else STATES[0], []
        events = pd.concat(list(rows)).sort_values(["seq", "dst"])
        for seq, dst in zip(events["seq"], events["dst"], strict=True):
            ok = dst == ERROR or (now != ERROR and dst in STATES and STATES.index(dst) > STATES.index(now))
            out.append((key[0], seq, now, dst, ok))
            now = dst if ok else now
        self.now.update((now,))
        yield pd.DataFrame(out, columns=["key", "seq", "src", "dst", "ok"])

    def close(self) -> None:
        pass


def lifecycle(stream: DataFrame, key: str, seq: str, state_col: str) -> DataFrame:
    """(key, seq, src, dst, ok) for each event: the state moves when ok; the others are for the dead letters."""
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), F.col(seq).cast("bigint").alias("seq"), F.col(state_col).alias("dst"))
    return rows.groupBy("key").transformWithStateInPandas(Lifecycle(), f"key {kind}, seq bigint, src string, dst string, ok boolean", "Append", "None")


class Cache(StatefulProcessor):
    """The last link found for each key, for so many days; events of one time: what was found before what is asked."""

    def __init__(self, days: int):
        self.span = days * 86_400_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.found = handle.getValueState("found", "url string, us bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        url, since = self.found.get() if self.found.exists() else (None, None)
        events, out, new = pd.concat(list(rows)), [], False
        events = events.assign(asks=events["url"].isna()).sort_values(["us", "asks", "url"])
        for us, given, asks in zip(events["us"], events["url"], events["asks"], strict=True):
            if not asks:
                url, since, new = given, int(us), True
            else:
                fresh = since is not None and us - since < self.span
                out.append((key[0], us, url if fresh else None))
        if new:
            self.found.update((url, since))
            self.handle.registerTimer((since + self.span) // 1000)
        if out:
            yield pd.DataFrame(out, columns=["key", "us", "url"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.found.exists() and self.found.get()[1] + self.span <= expiredTimerInfo.getExpiryTimeInMs() * 1000 + 999:
            self.found.clear()
        return iter(())

    def close(self) -> None:
        pass


def cached(stream: DataFrame, key: str, time: str, url: str, days: int = 30, delay: str = "1 hour") -> DataFrame:
    """(key, t, url) for each row without a url, which asks: the last link that a row with one has brought, while it's fresh, or null. Links are forgotten when the watermark has passed their time."""
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), F.col(time).cast("timestamp").alias("t"), F.col(url).alias("url")).withWatermark("t", delay).withColumn("us", F.unix_micros("t"))
    out = rows.groupBy("key").transformWithStateInPandas(Cache(days), f"key {kind}, us bigint, url string", "Append", "EventTime")
    return out.select("key", F.timestamp_micros("us").alias("t"), "url")
