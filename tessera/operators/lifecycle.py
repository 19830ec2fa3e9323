"""Document lifecycle: natural keys, upserts from an event log, and the state machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import ordered

# The states in their order; the error state can be entered from any, and isn't left.
STATES = ["PENDING", "DOWNLOADED", "EXTRACTED", "OCR_COMPLETED", "CLEANED", "CHUNKED", "TAGGED", "COMPLETED"]
ERROR = "ERROR"


def doc_key(ticker: Column, year: Column) -> Column:
    return F.concat_ws("_", ticker, year.cast("string"))


def ordinal(state: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STATES)), state)


def can_move(src: Column, dst: Column) -> Column:
    """To the error state always, from it never, else forward only (skipping is fine); an unknown state can't be entered."""
    return F.when(dst == ERROR, True).when(src == ERROR, False).otherwise((ordinal(dst) > ordinal(src)) & (ordinal(dst) > 0))


def steps(events: DataFrame, key: str, seq: str, state: str, hot: int = ordered.HOT) -> DataFrame:
    """(key, seq, src, dst, ok) of each event, in order of seq and then state: what it met, and whether it moved the document.

    An illegal event never lies beyond the state it meets, so the state is the furthest event before, or the error state
    once that was entered: two running maxima instead of a fold. A document of `hot` events or more is split.
    """
    rows = events.select(key, F.col(seq).cast("bigint").alias("seq"), F.col(state).alias("dst"))
    values = {"_far": ("max", ordinal(F.col("dst"))), "_failed": ("max", F.col("dst") == ERROR)}
    rows = ordered.running(rows, [key], [F.col("seq").asc_nulls_last(), F.col("dst").asc_nulls_last()], values, hot=hot)
    at = F.element_at(F.array(*map(F.lit, STATES)), F.greatest(F.col("_far"), F.lit(1)).cast("int"))
    rows = rows.select(key, "seq", F.when(F.coalesce("_failed", F.lit(False)), ERROR).otherwise(at).alias("src"), "dst")
    return rows.withColumn("ok", F.coalesce(can_move(F.col("src"), F.col("dst")), F.lit(False)))


def fold(events: DataFrame, key: str, seq: str, state: str, hot: int = ordered.HOT) -> DataFrame:
    """(key, state, n, n_rejects): the events of each document in order, through the machine; illegal ones change nothing and are counted, and listed by steps()."""
    furthest = F.greatest(F.max(ordinal(F.col("dst"))), F.lit(1)).cast("int")
    now = F.when(F.coalesce(F.bool_or(F.col("dst") == ERROR), F.lit(False)), ERROR).otherwise(F.element_at(F.array(*map(F.lit, STATES)), furthest))
    return steps(events, key, seq, state, hot).groupBy(key).agg(now.alias("state"), F.count_if("ok").cast("int").alias("n"), F.count_if(~F.col("ok")).cast("int").alias("n_rejects"))


def upserted(events: DataFrame, key: str, seq: str, columns: list[str]) -> DataFrame:
    """(key, columns...): of each column the last value that isn't null, as if each event were inserted or else updated with COALESCE(new, old). A map-side combined aggregate, for logs of any skew."""
    return events.groupBy(key).agg(*(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in columns))


def merged(table: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """table with changes (a row a key) merged in; new keys are added."""
    new = changes.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in columns))
    both = table.join(new, F.col(key) == F.col("_k"), "full")
    return both.select(F.coalesce(key, "_k").alias(key), *(F.coalesce(f"_{c}", c).alias(c) for c in columns))


def state_of(documents: DataFrame, doc_id: str) -> str | None:
    """The state of one document, or None if there's no such document; the filter reaches the scan."""
    row = documents.filter(F.col("doc_id") == doc_id).select("state").first()
    return row.state if row else None
