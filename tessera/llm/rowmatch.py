"""Row pattern matching: a sequence of quantified letters over consecutive rows of a key, as a backtracking matcher finds it.

Rows are dealt by (key, order) range, so that a key of any size is many tasks' work, and packed into pages. Any match
that starts in a page ends in it or in its overhang: the rows after it up to the first that no match from before can
reach, found by running the automaton over them from all of its states. Pages and overhangs meet in a join by page, so
nothing is gathered in one task or on the driver.

In a page, a right-to-left DP stores for each state of the automaton and each row the largest value of a match's first
row with which the rest can still succeed; a first row whose value is within that of the first state starts a match,
and the walk to the right takes, of the ways that its value still allows, the first in order of preference: what a
backtracking matcher ends with, without ever going back.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tessera.llm import _text as tx
from tessera.llm._spark import cut, drop_table, table

#: Rows of a page, and rows that are worth a task of their own.
PAGE, LEAST = 1 << 16, 1 << 12
_NEVER, _ANY = np.int64(-(1 << 62)), np.int64(1 << 62)


class Letter(NamedTuple):
    """What a row must be to fit: `where` (SQL over the row alone), its measure against the row before it (-1 below, 1 above, 0 either), at most `within` microseconds after it, and, with `floor`, a measure of at least the match's first row's."""

    where: str | None = None
    move: int = 0
    within: int | None = None
    floor: bool = False


class Place(NamedTuple):
    """A letter's place in the pattern, and where a matcher goes from it: places in order of preference, -1 for the end."""

    letter: str
    ways: tuple[int, ...]


def parse(pattern: str) -> list[Place]:
    """Letters with nothing, +, * or ? behind each (all greedy); white space means nothing. The first letter stands alone, once."""
    parts: list[list[str]] = []
    for c in pattern:
        if c in "+*?":
            if not parts or parts[-1][1]:
                raise ValueError(f"{c} stands behind nothing in {pattern!r}")
            parts[-1][1] = c
        elif c.isalpha():
            parts.append([c, ""])
        elif not c.isspace():
            raise ValueError(f"{c!r} in {pattern!r} has no meaning here")
    if not parts or parts[0][1]:
        raise ValueError("a pattern starts with a letter that stands once")
    out = []
    for i, (letter, many) in enumerate(parts):
        ways = [i] if many in ("+", "*") else []
        for k in range(i + 1, len(parts) + 1):
            ways.append(k if k < len(parts) else -1)
            if k < len(parts) and parts[k][1] not in ("*", "?"):
                break
        out.append(Place(letter, tuple(ways)))
    return out


class Rows(NamedTuple):
    """Columns of consecutive rows: hash of the key, key, microseconds, id, measure, whether it is known, and a bit for each place whose letter's own condition holds."""

    key: np.ndarray
    time: np.ndarray
    id: np.ndarray
    value: np.ndarray
    bits: np.ndarray

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        return Rows(*(np.concatenate(c) for c in zip(*parts, strict=True)))

    def part(self, a: int, b: int) -> Rows:
        return Rows(*(c[a:b] for c in self))

    def packed(self) -> bytes:
        head = np.array([len(self.key)], np.int64).tobytes()
        return zstandard.ZstdCompressor(level=1).compress(head + b"".join(c.tobytes() for c in self))

    @staticmethod
    def opened(content: bytes) -> Rows:
        raw = zstandard.decompress(content)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        wide = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n)
        return Rows(*wide, np.frombuffer(raw, np.uint32, n, 8 + 32 * n))


def fits(rows: Rows, places: list[Place], letters: dict[str, Letter]) -> np.ndarray:
    """Which places each row fits, a row of flags a place; the first row has none before it."""
    same = np.zeros(len(rows.key), bool)
    same[1:] = (rows.key[1:] == rows.key[:-1]) & ((rows.bits[1:] & rows.bits[:-1] & 1).astype(bool))  # of one key, and both measures known
    near = np.zeros(len(rows.key), np.int64)
    near[1:] = rows.time[1:] - rows.time[:-1]
    step = np.zeros(len(rows.key), np.int8)
    step[1:] = np.sign(rows.value[1:] - rows.value[:-1])
    out = np.zeros((len(places), len(rows.key)), bool)
    for k, p in enumerate(places):
        own = letters[p.letter]
        ok = (rows.bits >> np.uint32(k + 1) & 1).astype(bool)
        if k:
            ok &= same
            if own.move:
                ok &= step == own.move
            if own.within is not None:
                ok &= near <= own.within
        out[k] = ok
    return out


def overhang(rows: Rows, places: list[Place], letters: dict[str, Letter]) -> tuple[int, bool]:
    """How many of these rows a match from before them can reach at most, and whether it may go on beyond them all."""
    ok = fits(rows, places, letters)
    live = set(range(len(places)))  # nothing is known of the row before
    for r in range(len(rows.key)):
        reached = {k for j in live for k in places[j].ways if k > 0 and (ok[k, r] or r == 0 and rows.bits[0] >> np.uint32(k + 1) & 1)}
        live = {k for k in reached if places[k].ways != (-1,)}
        if not live:
            return r + 1, False
    return len(rows.key), True


def find(rows: Rows, n: int, places: list[Place], letters: dict[str, Letter]) -> tuple[np.ndarray, np.ndarray]:
    """First rows (of the first n) of all matches, ascending, and how many rows each place took of each."""
    ok = fits(rows, places, letters)
    size = len(rows.key)
    cap = [rows.value if letters[p.letter].floor else np.full(size, _ANY) for p in places]
    # Chains: runs of rows of which each but the first fits a place that a match can go on with.
    later = ok[1:].any(0)
    first = np.flatnonzero(~later)
    count = np.diff(np.append(first, size)) if size else first
    by = np.argsort(-count, kind="stable")
    last, count = (first + count - 1)[by], count[by]
    live = np.searchsorted(-count, -np.arange(1, int(count.max(initial=0))), "left")  # chains with more rows than this
    rest = np.full((len(places), size + 1), _NEVER)  # of a row and the place it has taken
    for j, p in enumerate(places):
        if -1 in p.ways:
            rest[j, :size] = _ANY
    for back, k_live in enumerate(live.tolist()):
        r = last[:k_live] - back - 1
        for j, p in enumerate(places):
            best = rest[j, r]
            for k in p.ways:
                if k > 0:
                    through = np.where(ok[k, r + 1], np.minimum(cap[k][r + 1], rest[k, r + 1]), _NEVER)
                    best = np.maximum(best, through)
            rest[j, r] = best
    start = np.flatnonzero(ok[0, :n] & (rows.value[:n] <= rest[0, :n]))
    took = np.zeros((len(start), len(places)), np.int64)
    took[:, 0] = 1
    at, place, who = start.copy(), np.zeros(len(start), np.int64), np.arange(len(start))
    while len(who):
        goes = np.full(len(who), -1)
        for j, p in enumerate(places):
            here = np.flatnonzero(place == j)
            if not len(here):
                continue
            nxt = np.minimum(at[here] + 1, size - 1)
            inside, value, done = at[here] + 1 < size, rows.value[start[who[here]]], np.zeros(len(here), bool)
            for k in p.ways:
                if k < 0:
                    break  # what has found no way ends here
                free = ~done & inside & ok[k, nxt] & (value <= np.minimum(cap[k][nxt], rest[k, nxt]))
                goes[here[free]] = k
                done |= free
        on = np.flatnonzero(goes >= 0)
        who, at, place = who[on], at[on] + 1, goes[on]
        took[who, place] += 1
    return start, took


def _pack(places: list[Place], letters: dict[str, Letter], most: int):
    def run(batches):
        from pyspark import TaskContext

        block, held, n, page = TaskContext.get().partitionId(), [], 0, 0

        def emit(rows: Rows, ends: bool):
            head, through = overhang(rows, places, letters)
            cols = [pa.array([x], t) for x, t in ((block, pa.int32()), (page, pa.int64()), (ends, pa.bool_()), (rows.packed(), pa.binary()), (rows.part(0, head).packed(), pa.binary()), (through, pa.bool_()))]
            return pa.RecordBatch.from_arrays(cols, ["block", "page", "ends", "content", "head", "through"])

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            held.append(Rows(*cols, batch.column(4).to_numpy(zero_copy_only=False).astype(np.uint32)))
            n += batch.num_rows
            while n > most:  # the last rows stay, so that the block's last page is known
                rows = Rows.joined(held)
                yield emit(rows.part(0, most), False)
                held, n, page = [rows.part(most, n)], n - most, page + 1
        if n:
            yield emit(Rows.joined(held), True)

    return tx.released(run)


_FIELDS = "block int, page long, key long, nth long, start_time long, first_id long, last_id long, n_rows long, total long, labels string"


def _match(places: list[Place], letters: dict[str, Letter]):
    def run(batches):
        for batch in batches:
            for block, page, content, tails in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                own = Rows.opened(content)
                n = len(own.key)
                rows = Rows.joined([own, *map(Rows.opened, tails or [])])
                start, took = find(rows, n, places, letters)
                if not len(start):
                    continue
                length = took.sum(1)
                total = np.concatenate(([0], np.cumsum(np.where(rows.bits & 1, rows.value, 0))))
                kinds, which = np.unique(took, axis=0, return_inverse=True)
                words = pa.array(["".join(p.letter * c for p, c in zip(places, k, strict=True)) for k in kinds.tolist()])
                key = own.key[start]
                new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                nth = np.arange(len(start)) - np.repeat(new, np.diff(np.append(new, len(start)))) + 1
                cols = [pa.array([block] * len(start), pa.int32()), pa.array([page] * len(start), pa.int64()), *map(pa.array, (key, nth, own.time[start], own.id[start], rows.id[start + length - 1], length, total[start + length] - total[start])), words.take(pa.array(which.reshape(-1)))]
                yield pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in _FIELDS.split(", ")])

    return tx.released(run)


def _with_overhangs(pages: DataFrame) -> DataFrame:
    """pages (block, page, content) with the overhangs that follow each, as a list.

    A page's next one is the next of its block, or the first of the next block that has rows (there is a row a block to
    find that). A page that a match may cross in full passes on to the one after it, in rounds; as a rule there is none.
    """
    following = pages.filter("page = 0").select("block", F.lead("block").over(Window.orderBy("block")).alias("next_block"))
    step = pages.filter("ends").select("block", "page").join(following, "block").select("block", "page", "next_block", F.lit(0).cast("long").alias("next_page"))
    step = step.unionByName(pages.filter("not ends").select("block", "page", F.col("block").alias("next_block"), (F.col("page") + 1).alias("next_page")))
    heads = pages.select(F.col("block").alias("h_block"), F.col("page").alias("h_page"), "head", "through")
    links = cut(step.join(heads, (F.col("next_block") == F.col("h_block")) & (F.col("next_page") == F.col("h_page"))).select("block", "page", "h_block", "h_page", F.array("head").alias("tails"), F.col("through").alias("more")))
    open_ = links.filter("more")
    done = links.filter("not more")
    after = links.select(F.col("block").alias("b"), F.col("page").alias("p"), F.col("h_block").alias("to_block"), F.col("h_page").alias("to_page"))
    while not open_.isEmpty():
        moved = open_.drop("more").join(after, (F.col("h_block") == F.col("b")) & (F.col("h_page") == F.col("p")), "left").select("block", "page", "tails", F.col("to_block").alias("n_block"), F.col("to_page").alias("n_page"))
        found = moved.join(heads, (F.col("n_block") == F.col("h_block")) & (F.col("n_page") == F.col("h_page")), "left")
        found = cut(found.select("block", "page", F.col("n_block").alias("h_block"), F.col("n_page").alias("h_page"), F.when(F.col("head").isNull(), F.col("tails")).otherwise(F.concat("tails", F.array("head"))).alias("tails"), F.coalesce("through", F.lit(False)).alias("more")))
        done, open_ = done.unionByName(found.filter("not more")), found.filter("more")
    ends = done.select(F.col("block").alias("b"), F.col("page").alias("p"), "tails")
    return pages.select("block", "page", "content").join(ends, (F.col("block") == F.col("b")) & (F.col("page") == F.col("p")), "left").select("block", "page", "content", "tails")


def match(rows: DataFrame, key: str, time: str, row_id: str, measure: Column, pattern: str, letters: dict[str, Letter], page: int = PAGE, least: int = LEAST) -> DataFrame:
    """One row for each match: key, match_no (from 1 a key, by first row), first_id, last_id, n_rows, total (of the measure, a long), labels (a letter a row).

    The rows of a key, repeated ones once, are ordered by time and then id; rows without a key or a time are dropped. A
    row whose measure is null fits no letter, nor does the row after it fit one that needs the row before. Every row is
    tried as a first row. Ids may be null (they come first) or repeat (rows that differ elsewhere keep an order of their
    own). An empty table has no matches; other columns only tell rows apart.
    """
    places = parse(pattern)
    if len(places) > 30:
        raise ValueError("a pattern has 30 letters at most")
    spark, kind = rows.sparkSession, rows.schema[key].dataType
    bits = F.when(F.col("_m").isNotNull(), 1).otherwise(0)
    for k, p in enumerate(places):
        own = letters[p.letter].where
        bits += F.when(F.col("_m").isNotNull() & (F.lit(True) if own is None else F.coalesce(F.expr(own), F.lit(False))), 2 << k).otherwise(0)
    name = lambda f: F.col("`" + f.name.replace("`", "``") + "`")
    rest = F.xxhash64(*(F.map_entries(name(f)) if isinstance(f.dataType, MapType) else name(f) for f in rows.schema))
    known = rows.withColumn("_rest", rest).filter(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_m", measure.cast("long"))
    bare = known.select(F.col(key).cast("long").alias("key"), F.unix_micros(F.col(time).cast("timestamp")).alias("time"), F.col(row_id).cast("long").alias("id"), F.coalesce("_m", F.lit(0)).alias("value"), bits.cast("int").alias("bits"), F.col("_rest").alias("rest")).distinct()
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / least)))
    order = ["key", "time", F.col("id").asc_nulls_first(), "value", "bits", "rest"]
    dealt = bare.repartitionByRange(n, *order).sortWithinPartitions(*order).select("key", "time", F.coalesce("id", F.lit(-(1 << 63))).alias("id"), "value", "bits")
    plain = {k: v._replace(where=None) for k, v in letters.items()}
    pages, path = table(dealt.mapInArrow(_pack(places, plain, page), "block int, page long, ends boolean, content binary, head binary, through boolean"), "pages")
    found = cut(_with_overhangs(pages).mapInArrow(_match(places, plain), _FIELDS))
    drop_table(spark, path)
    # How many matches a key has in earlier pages of its block, and in earlier blocks; only for keys of several pages.
    own = found.groupBy("key", "block", "page").agg(F.count("*").alias("n"))
    several = own.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("n_pages")).filter("n_pages > 1")
    own = cut(own.join(several, F.col("key") == F.col("of"), "left_semi"))
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = own.groupBy("key", "block").agg(F.sum("n").alias("n")).select(F.col("key").alias("k"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(before("key", "block")), F.lit(0)).alias("earlier"))
    within = own.select("key", "block", "page", F.coalesce(F.sum("n").over(before("key", "block", "page")), F.lit(0)).alias("here"))
    shift = within.join(blocks, (F.col("key") == F.col("k")) & (F.col("block") == F.col("b"))).select(F.col("key").alias("k"), F.col("block").alias("b"), F.col("page").alias("p"), (F.col("earlier") + F.col("here")).alias("shift"))
    out = found.join(shift, (F.col("key") == F.col("k")) & (F.col("block") == F.col("b")) & (F.col("page") == F.col("p")), "left")
    null = lambda c: F.when(F.col(c) != -(1 << 63), F.col(c)).alias(c)
    return out.select(F.col("key").cast(kind).alias(key), (F.col("nth") + F.coalesce("shift", F.lit(0))).alias("match_no"), null("first_id"), null("last_id"), "n_rows", "total", "labels")
