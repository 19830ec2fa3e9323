"""Packing documents into sequences of bounded length: dominance reduction, then best fit.

Only a piece's length matters, so an instance is a table of counts, one for each length up to the capacity; it and the
plan made from it have sizes that depend on the capacity alone, and are all that the driver sees. The plan puts runs of
pieces of one length into runs of sequences; each piece finds its own place by its number among those of its length,
which tasks give out on their own and a scan of their counts (a row a task and length) makes global.

Martello and Toth's reduction looks at the longest remaining piece and sets of up to two more: where one set dominates
all others (each of theirs can be split into parts that fit into pieces of it), some best packing has it, so it's fixed
for good, as often as counts allow. What is left goes, longest first, to the fullest sequence that has room.
"""

from __future__ import annotations

import bisect
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm._spark import cut
from tessera.llm.bpe import tokenizer_encoder

_SLICE = 8 << 20


class Run(NamedTuple):
    """Pieces first, first + 1, ... (n of them) of a length: `each` side by side in a sequence from `offset`, in sequences from `bin` on."""

    length: int
    first: int
    n: int
    bin: int
    each: int
    offset: int


class _Lengths:
    """Counts of the remaining pieces by length, and the lengths that remain, ascending."""

    def __init__(self, counts: np.ndarray):
        self.left = [int(c) for c in counts]
        self.given = [0] * len(self.left)
        self.known = [i for i, c in enumerate(self.left) if c]

    def take(self, length: int, n: int) -> int:
        """Takes n pieces; the number of the first."""
        first = self.given[length]
        self.given[length] += n
        self.left[length] -= n
        if not self.left[length]:
            self.known.remove(length)
        return first

    def smallest(self, k: int, without: int) -> list[int]:
        """The k smallest lengths besides one piece of length `without`; fewer if there are no more."""
        out: list[int] = []
        for x in self.known:
            out += [x] * min(k - len(out), self.left[x] - (x == without))
            if len(out) == k:
                break
        return out

    def largest(self, most: int, without: tuple[int, ...]) -> int | None:
        """The largest length of at most `most` besides the pieces in `without`."""
        for i in range(bisect.bisect_right(self.known, most) - 1, -1, -1):
            if self.left[self.known[i]] > without.count(self.known[i]):
                return self.known[i]
        return None


def _second(own: _Lengths, longest: int, room: int) -> int:
    """The largest length y for which a piece x >= y fits beside it into room; 0 if no two pieces fit."""
    for i in range(bisect.bisect_right(own.known, room // 2) - 1, -1, -1):
        y = own.known[i]
        x = own.largest(room - y, (longest, y))
        if x is not None and x >= y:
            return y
    return 0


def _pair(own: _Lengths, longest: int, room: int) -> int:
    """The largest sum of two pieces that fit into room, 0 if none do."""
    best = 0
    for y in own.known:
        if 2 * y > room:
            break
        x = own.largest(room - y, (longest, y))
        if x is not None and x >= y:
            best = max(best, x + y)
    return best


def _dominating(own: _Lengths, longest: int, capacity: int) -> list[int] | None:
    """What goes with the longest piece in a set that dominates all its others; None if none is found."""
    room = capacity - longest
    few = own.smallest(3, longest)
    if not few or few[0] > room:
        return []
    one = own.largest(room, (longest,))
    if one == room or len(few) < 2 or few[0] + few[1] > room:
        return [one]
    if len(few) < 3 or sum(few) > room:  # two more pieces at most
        if one >= _pair(own, longest, room):
            return [one]
        two = own.largest(room - one, (longest, one))
        if two is not None and two >= _second(own, longest, room):
            return [one, two]
    return None


def plan(counts: np.ndarray) -> tuple[list[Run], int]:
    """Runs for an instance (counts[i] pieces of length i, the capacity being the last index), and the number of sequences."""
    capacity = len(counts) - 1
    if counts[0]:
        raise ValueError("a piece has no length")
    own, runs, bins = _Lengths(counts), [], 0
    settled = False
    while not settled:  # what is fixed may let more be fixed
        settled = True
        for length in sorted(own.known, reverse=True):
            while own.left[length]:
                more = _dominating(own, length, capacity)
                if more is None:
                    break
                members = [length, *more]
                n = min(own.left[x] // members.count(x) for x in set(members))
                at = 0
                for x in dict.fromkeys(members):
                    each = members.count(x)
                    runs.append(Run(x, own.take(x, n * each), n * each, bins, each, at))
                    at += each * x
                bins += n
                settled = False
    # Open sequences by the room that they have: runs of (first sequence, how many).
    rooms: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []

    def opened(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in rooms:
                rooms[room] = []
                bisect.insort(order, room)
            rooms[room].append((first, n))

    for length in sorted(own.known, reverse=True):
        while own.left[length]:
            i = bisect.bisect_left(order, length)
            if i == len(order):
                each = capacity // length
                n = own.left[length] // each or 1
                room, first, wide = capacity, bins, n
                bins += n
            else:
                room = order[i]
                first, wide = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[i]
            each = min(room // length, own.left[length])
            n = min(wide, own.left[length] // each)
            runs.append(Run(length, own.take(length, n * each), n * each, first, each, capacity - room))
            opened(room - each * length, first, n)
            opened(room, first + n, wide - n)
    return runs, bins


def bound(counts: np.ndarray) -> int:
    """No packing takes fewer sequences: Martello and Toth's second lower bound."""
    capacity = len(counts) - 1
    n = np.asarray(counts, np.int64)
    size = np.arange(capacity + 1)
    upto, mass = np.concatenate(([0], np.cumsum(n))), np.concatenate(([0], np.cumsum(n * size)))
    best = -(-int(mass[-1]) // capacity)
    for a in range(1, capacity // 2 + 1):  # pieces shorter than a are left out
        large, half = int(upto[-1] - upto[capacity - a + 1]), int(upto[capacity - a + 1] - upto[capacity // 2 + 1])
        room = half * capacity - int(mass[capacity - a + 1] - mass[capacity // 2 + 1])
        best = max(best, large + half + max(0, -(-(int(mass[capacity // 2 + 1] - mass[a]) - room) // capacity)))
    return best


def _pieces(path: str, end_id: int, capacity: int, recognise: bool, with_ids: bool):
    def run(batches):
        from pyspark import TaskContext

        encoder = tokenizer_encoder(path, recognise)
        part, given = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo, hi, buf, offs in tx.slices(batch.column(1), _SLICE):
                ids, n = encoder(buf, offs)
                ends = np.cumsum(n + 1)
                flat = np.full(int(ends[-1]), end_id, np.uint32)
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = ids
                n = n + 1
                many = -(-n // capacity)
                row = np.repeat(np.arange(hi - lo), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                lead = (n - (many - 1) * capacity)[row]  # the first piece has what is left over
                start = np.where(piece > 0, lead + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, lead)
                at = (ends - n)[row] + start
                # The number of each piece among those of its length in this task.
                by = np.argsort(length, kind="stable")
                kinds, first, count = np.unique(length[by], return_index=True, return_counts=True)
                nth = np.empty(len(row), np.int64)
                nth[by] = np.arange(len(row)) - np.repeat(first, count) + np.repeat(given[kinds], count)
                given[kinds] += count
                raw = memoryview(flat.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                cols = [batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int32()), pa.array(nth)]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(flat)).astype(np.int32)), pa.array(flat.view(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"][: len(cols)])

    return tx.released(run)


def _placed(shared):
    """(..., length, number) becomes (..., length, sequence_id, offset)."""

    def run(batches):
        key, runs = shared.value
        for batch in batches:
            k = batch.num_columns - 2
            length, number = (batch.column(k + i).to_numpy() for i in (0, 1))
            own = runs[np.searchsorted(key, length << 48 | number, "right") - 1]
            inner = number - own[:, 1]
            cols = [pa.array(own[:, 3] + inner // own[:, 4]), pa.array(own[:, 5] + inner % own[:, 4] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *cols], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return tx.released(run)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, recognise: bool = False, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece (from 0), start (its document's ids before it), ids_crc32, [ids,] length, sequence_id, offset.

    A document is its text's ids by a tokenizers file (recognise: the file's added tokens among them) and end_id; a null
    text is an empty one. A document of more than `capacity` ids is cut into pieces of that many, of which the first may
    be shorter; no other is cut. Rows are packed one by one, so repeated rows and null ids have places of their own; a
    text may be of any length; an empty table gives no pieces; other columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * with_ids
    pieces = cut(docs.mapInArrow(_pieces(tokenizer, end_id, capacity, recognise, with_ids), fields))
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    total = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row a length
        total[r.length] = r.n
    runs = np.array(sorted(plan(total)[0]) or [Run(0, 0, 0, 0, 1, 0)], np.int64)
    shared = spark.sparkContext.broadcast((runs[:, 0] << 48 | runs[:, 1], runs))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("part").alias("of"), F.col("length").alias("sized"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(before, (F.col("part") == F.col("of")) & (F.col("length") == F.col("sized")))
    keep = ["doc_id", "piece", "start", "ids_crc32", *["ids"] * with_ids, "length"]
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    out = numbered.select(*keep, (F.col("nth") + F.col("before")).alias("number"))
    return out.mapInArrow(_placed(shared), ", ".join(f"{c} {kinds[c]}" for c in keep) + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids and doc_ids (of its pieces, in order) of each sequence, from pack() with ids; a sequence holds `capacity` ids at most."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    own = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), ordered.alias("own"))
    return own.select("sequence_id", "length", F.flatten(F.col("own.ids")).alias("ids"), F.col("own.doc_id").alias("doc_ids"))
