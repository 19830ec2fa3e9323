"""Substring deduplication by content-defined chunking with a gear rolling hash.

The gear hash (16 bytes wide) is read at the end of each word; a chunk ends where it is the largest within REACH words
on either side, so cuts depend on nearby text alone and come back into step right after an insertion. Chunks hold
between REACH + 1 words and, in text without a largest place, MOST. A chunk is shared if its digest occurs in another
document or earlier in the same one. Of a run of chunks that are each shared with an earlier place, and that together
hold min_words words or more, every word is removed. Digests have 64 bits: of 10**13 chunks some collide, but text goes
only where all chunks of a run do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx

U = np.uint64
REACH, MOST = 3, 64
#: Words in a run that make it a repeated passage. The chunks at a passage's two ends also hold words around it and don't repeat, which leaves well over this of any 50 words.
MIN_WORDS = 20
_GEAR = tx.seeds(256, 41)
_SLICE = 2 << 20


def gear(buf: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: h = (h << 4) + G[byte], over the last 16 bytes."""
    h = _GEAR[buf]
    for w in (1, 2, 4, 8):
        more = h.copy()
        more[w:] += h[:-w] << U(4 * w)
        h = more
    return h


def chunks(buf: np.ndarray, offs: np.ndarray):
    """Word starts, word ends, each row's first word (one more at the end), each chunk's first word (one more at the end), each row's first chunk (ditto), and the chunks' digests."""
    starts, ends, first = tx.spans(buf, offs, tx.SOLID)
    n = len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return starts, ends, first, np.zeros(1, np.int64), np.zeros(len(offs), np.int64), none.view(U)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    v = tx.mix(gear(buf)[ends - 1])
    v[ends - offs[row] < 16] = 0  # the window would reach into the row before
    top = v > 0
    for j in range(1, REACH + 1):
        same = row[j:] == row[:-j]
        top[j:] &= ~same | (v[j:] > v[:-j])
        top[:-j] &= ~same | (v[:-j] >= v[j:])
    begin = np.zeros(n, bool)
    begin[1:] = top[:-1]
    begin[first[:-1][np.diff(first) > 0]] = True
    at = np.flatnonzero(begin)
    size = np.diff(np.append(at, n))
    if size.max() > MOST:
        parts = (size + MOST - 1) // MOST
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.repeat(at, parts) + inner * MOST
    edge = np.append(at, n)
    h = tx.hashes(buf, starts, ends)
    place = np.arange(n) - np.repeat(at, np.diff(edge))
    digests = np.add.reduceat(tx.mix(h + place.astype(U) * _GEAR[0]), at)
    return starts, ends, first, edge, np.searchsorted(at, first), tx.mix(digests + np.diff(edge).astype(U))


@tx.released
def _digests(batches):
    """(digest, doc_id): each distinct chunk of each row."""
    for batch in batches:
        for lo, hi, buf, offs in tx.slices(batch.column(1), _SLICE):
            *_, own, d = chunks(buf, offs)
            row = np.repeat(np.arange(hi - lo), np.diff(own))
            by = np.lexsort((d, row))
            new = by[np.concatenate(([True], (d[by][1:] != d[by][:-1]) | (row[by][1:] != row[by][:-1])))] if len(by) else by
            ids = batch.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(d[new].view(np.int64)), pa.array(ids[row[new]])], ["digest", "doc_id"])


def _runs(flags: np.ndarray, words: np.ndarray, min_words: int) -> np.ndarray:
    """flags, without the runs that hold fewer than min_words words."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    out = np.zeros(len(flags), bool)
    total = np.concatenate(([0], np.cumsum(words)))
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        if total[b] - total[a] >= min_words:
            out[a:b] = True
    return out


def _apply(min_words: int):
    def run(batches):
        for batch in batches:
            at = 0
            for lo, hi, buf, offs in tx.slices(batch.column(1), _SLICE):
                starts, ends, first, edge, own, d = chunks(buf, offs)
                ids = batch.column(0).slice(lo, hi - lo).to_pylist()
                lists = [batch.column(i).slice(lo, hi - lo).to_pylist() for i in (2, 3)]
                size = np.diff(edge)
                texts, out = [], []
                for i in range(hi - lo):
                    raw = buf[offs[i] : offs[i + 1]].tobytes()
                    a, b = own[i], own[i + 1]
                    mine, words = d[a:b].view(np.int64), size[a:b]
                    by = np.argsort(mine, kind="stable")
                    again = np.zeros(b - a, bool)
                    again[by[1:]] = mine[by][1:] == mine[by][:-1]
                    shared, firsts = np.array(lists[0][i] or [], np.int64), np.array(lists[1][i] or [], np.int64)
                    order = np.argsort(shared)
                    shared, firsts = shared[order], firsts[order]
                    place = np.searchsorted(shared, mine) if len(shared) else np.zeros(b - a, np.int64)
                    known = (shared[np.minimum(place, len(shared) - 1)] == mine) if len(shared) else np.zeros(b - a, bool)
                    source = firsts[np.minimum(place, len(shared) - 1)] if len(shared) else mine
                    later = again | known & (source != (ids[i] if ids[i] is not None else 0))
                    twice = np.isin(mine, mine[again]) | known
                    gone, rep = _runs(later, words, min_words), _runs(twice, words, min_words)
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    cuts = []
                    for x, y in zip(edges[::2], edges[1::2], strict=True):
                        last = edge[a + y]
                        cuts += [int(starts[edge[a + x]] - offs[i]), int((starts[last] if last < first[i + 1] else ends[last - 1]) - offs[i])]
                    kept, pos = [], 0
                    for x, y in zip(cuts[::2], cuts[1::2], strict=True):
                        kept.append(raw[pos:x])
                        pos = y
                    texts.append(b"".join([*kept, raw[pos:]]))
                    out.append((len(mine), int(words.sum()), int(words[rep].sum()), int(words[gone].sum()), cuts, sorted(set(source[gone & known].tolist()))))
                cols = list(zip(*out, strict=True))
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
                text = tx.strings(texts)
                null = batch.column(1).slice(lo, hi - lo).is_null()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.compute.if_else(null, pa.scalar(None, pa.string()), text), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), *(c.slice(lo, hi - lo) for c in batch.columns[4:])], ["doc_id", "text", "n_chunks", "n_words", "n_repeated", "n_removed", "removed", "first_ids"])
                at = hi

    return tx.released(run)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each row of docs: doc_id, text (without removed passages), n_chunks, n_words, n_repeated, n_removed, removed, first_ids.

    n_repeated counts the words of repeated passages, first occurrences included; n_removed those that occur earlier (in
    a document of smaller id, or further up in the same one) and are removed, with the white space after them; removed
    holds their byte offsets (start, end, start, ...), first_ids the documents in which their chunks occur first. A null
    text stays null and has no words; a row with a null id is held against itself only; rows that share an id count as
    one document, so a text that repeats under one id is kept. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = docs.filter("doc_id is not null").mapInArrow(_digests, "digest long, doc_id long")
    shared = own.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).filter("first_id < last_id").select("digest", "first_id")
    # A row for each shared chunk of each document, gathered by document: at most as many as its text has.
    lists = own.join(shared, "digest").groupBy("doc_id").agg(F.collect_list("digest").alias("digests"), F.collect_list("first_id").alias("firsts")).withColumnRenamed("doc_id", "of")
    both = docs.join(lists, F.col("doc_id") == F.col("of"), "left").select("doc_id", "text", "digests", "firsts")
    return both.mapInArrow(_apply(min_words), "doc_id long, text string, n_chunks long, n_words long, n_repeated long, n_removed long, removed array<long>, first_ids array<long>")
