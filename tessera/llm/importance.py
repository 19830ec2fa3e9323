"""Importance resampling towards a target: inverted postings by bucket, gains found where a bucket's postings meet.

A text's features are its runs of 1 to `n` words, each in a bucket by the CRC-32 of its bytes. Tasks turn slices of
texts into postings (bucket, document, count) and deal them by bucket, packed: a row holds one slice's postings of one
group of buckets. Counts of both corpora are summed up in each task first and come before the postings, so where a
group's rows meet, its gains are known from what has passed and the postings stream by. What each posting contributes
is summed up by document there, and the groups' sums of a slice meet in a second shuffle.

CRCs of runs come from those of their words: appending zeros to a message is linear in its CRC, so tables for each
length of a word give a run's CRC at four look-ups a word.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm._spark import cut
from tessera.operators import ordered

U32 = np.uint32
#: Longer words are looked at one by one.
WIDE = 48
_SLICE = 6 << 20
_FULL = U32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=U32)
    for _ in range(8):
        c = np.where(c & U32(1), U32(0xEDB88320) ^ (c >> U32(1)), c >> U32(1))
    return c


_TABLE = _crc_table()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _zeros() -> np.ndarray:
    """What n zero bytes behind a message make of each byte of its CRC: (n, byte's place, byte)."""
    own = np.arange(256, dtype=U32)[None, :] << (U32(8) * np.arange(4, dtype=U32)[:, None])
    out = [own]
    for _ in range(WIDE):
        own = _TABLE[own & U32(255)] ^ (own >> U32(8))
        out.append(own)
    return np.stack(out)


_ZEROS = _zeros().reshape(-1)


def word_crcs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span: all spans side by side, a byte of each at a time."""
    n = ends - starts
    by = np.argsort(-np.minimum(n, WIDE).astype(np.int8), kind="stable")
    at, size = starts[by], n[by]
    live = np.searchsorted(-np.minimum(size, WIDE), -np.arange(int(min(size.max(initial=0), WIDE))), "left")
    c = np.full(len(by), _FULL, U32)
    for p, k in enumerate(live.tolist()):
        c[:k] = _TABLE[(c[:k] ^ buf[at[:k] + p]) & U32(255)] ^ (c[:k] >> U32(8))
    out = np.empty(len(by), U32)
    out[by] = c ^ _FULL
    for i in np.flatnonzero(n > WIDE).tolist():
        out[i] = zlib.crc32(buf[starts[i] : ends[i]])
    return out


def longer(crc: np.ndarray, word: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRCs of messages of CRC `crc` with a space and then each span (of CRC `word`) behind them."""
    c = crc ^ _FULL
    c = _TABLE[(c ^ U32(32)) & U32(255)] ^ (c >> U32(8)) ^ _FULL
    n = ends - starts
    at = np.minimum(n, WIDE) * 1024
    out = word.copy()
    for place in range(4):
        out ^= _ZEROS[at + (place * 256) + ((c >> U32(8 * place)) & U32(255))]
    for i in np.flatnonzero(n > WIDE).tolist():
        out[i] = zlib.crc32(buf[starts[i] : ends[i]], int(c[i]))
    return out


def postings(buf: np.ndarray, offs: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys bucket * rows + row, ascending, and how often each occurs; each row's words and features."""
    rows = len(offs) - 1
    buf = _LOWER[buf]
    starts, ends, first = tx.spans(buf, offs, tx.ALNUM)
    words = np.diff(first)
    row = np.repeat(np.arange(rows, dtype=np.int64), words)
    crc = own = word_crcs(buf, starts, ends)
    kind = U32 if buckets * rows < 1 << 32 else np.uint64
    keys, features = [(own % U32(buckets)).astype(kind) * kind(rows) + row.astype(kind)], words.copy()
    for k in range(1, n):
        same = row[:-k] == row[k:] if k < len(row) else np.zeros(0, bool)
        # A run of k words from each place, then one word more: only runs within a row are kept.
        crc = longer(crc[: len(row) - k], own[k:], buf, starts[k:], ends[k:]) if k < len(row) else own[:0]
        keys.append((crc[same] % U32(buckets)).astype(kind) * kind(rows) + row[:-k][same].astype(kind) if len(crc) else own[:0].astype(kind))
        features += np.maximum(words - k, 0)
    keys = np.sort(np.concatenate(keys))
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.diff(np.append(new, len(keys))), words, features


def _planes(x: np.ndarray) -> bytes:
    """The low bytes of all values, then the next ones, and so on."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplaned(raw: bytes, kind, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).reshape(n)


_ROWS = "part int, kind int, slice long, mark long, n int, content binary"
_NAMES = [f.split()[0] for f in _ROWS.split(", ")]
#: What a row holds: counts of the source's or the target's features, a slice's documents, or its postings.
SOURCE, TARGET, DOCS, POSTS = range(4)


def _row(part: int, kind: int, slice_: int, mark: int, n: int, content: bytes):
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((part, pa.int32()), (kind, pa.int32()), (slice_, pa.int64()), (mark, pa.int64()), (n, pa.int32()), (content, pa.binary()))], _NAMES)


def _edges(buckets: int, groups: int) -> np.ndarray:
    """The first bucket of each group, and their number at the end."""
    return np.arange(groups + 1) * buckets // groups


def _dealt(n: int, buckets: int, groups: int, target: bool):
    def run(batches):
        from pyspark import TaskContext

        squeeze = zstandard.ZstdCompressor(level=1)
        task, seq = TaskContext.get().partitionId(), 0
        edges, total = _edges(buckets, groups), np.zeros(buckets, np.int64)
        for batch in batches:
            for lo, hi, buf, offs in tx.slices(batch.column(1), _SLICE):
                rows = hi - lo
                keys, count, words, features = postings(buf, offs, n, buckets)
                first = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) * np.uint64(rows))
                total += np.diff(np.concatenate(([0], np.cumsum(count)))[first])
                if target:
                    continue
                ids = batch.column(0).slice(lo, rows)
                head = np.stack([ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy(), words, features]).tobytes()
                name, mark = task << 32 | seq, zlib.crc32(buf.tobytes(), zlib.crc32(head))
                seq += 1
                yield _row(name % groups, DOCS, name, mark, rows, squeeze.compress(head))
                for g in range(groups):
                    a, b = first[edges[g]], first[edges[g + 1]]
                    own = keys[a:b] - keys.dtype.type(int(edges[g]) * rows)
                    gaps = np.diff(own, prepend=own.dtype.type(0)).astype(np.uint64 if own.dtype == np.uint64 else U32)
                    yield _row(g, POSTS, name, mark, rows, squeeze.compress(bytes([gaps.itemsize]) + _planes(gaps) + _planes(count[a:b].astype(U32))))
        size = int(total.sum())
        for g in range(groups):
            yield _row(g, TARGET if target else SOURCE, -1, 0, 0, np.append(total[edges[g] : edges[g + 1]], size).tobytes())

    return tx.released(run)


def gains(source: np.ndarray, target: np.ndarray, all_source: int, all_target: int, buckets: int) -> np.ndarray:
    return np.floor(1000 * np.log((target + 1.0) * (all_source + float(buckets)) / ((source + 1.0) * (all_target + float(buckets))))).astype(np.int64)


def _contributions(buckets: int, groups: int):
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        edges, sums, gain = _edges(buckets, groups), {}, None
        for batch in batches:
            for part, kind, name, mark, n, content in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                width = int(edges[part + 1] - edges[part])
                if kind in (SOURCE, TARGET):
                    own = np.frombuffer(content, np.int64)
                    sums[kind] = sums[kind] + own if kind in sums else own
                elif kind == DOCS:
                    yield _row(part, kind, name, mark, n, content)
                else:
                    if gain is None:  # counts come first
                        s, t = (sums.get(k, np.zeros(width + 1, np.int64)) for k in (SOURCE, TARGET))
                        gain = gains(s[:-1], t[:-1], s[-1], t[-1], buckets)
                    raw = zstandard.decompress(content)
                    wide = np.uint64 if raw[0] == 8 else U32
                    many = (len(raw) - 1) // (raw[0] + 4)
                    key = np.cumsum(_unplaned(raw, wide, many, 1), dtype=wide)
                    count = _unplaned(raw, U32, many, 1 + many * raw[0])
                    # Exact in doubles: a document's sum stays far below 2**53.
                    out = np.bincount((key % wide(n)).astype(np.int64), gain[(key // wide(n)).astype(np.int64)] * count.astype(np.int64), n)
                    yield _row(part, kind, name, mark, n, squeeze.compress(_planes(out.astype(np.int64))))

    return tx.released(run)


def _weights(groups: int):
    def run(batches):
        name = head = total = None
        met = 0

        def close():
            if met != groups:
                raise RuntimeError("a slice of texts was read in two orders; its rows must come in one")
            null, ids, words, features = np.frombuffer(head, np.int64).reshape(4, -1)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            return pa.RecordBatch.from_arrays([pa.array(ids, mask=null.astype(bool)), *map(pa.array, (words, features, weight))], ["doc_id", "n_words", "n_features", "weight"])

        for batch in batches:
            for kind, own, n, content in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if own != name:
                    if name is not None:
                        yield close()
                    if kind != DOCS:
                        raise RuntimeError("a slice of texts has lost its documents")
                    name, head, total, met = own, zstandard.decompress(content), np.zeros(n, np.int64), 0
                else:
                    total += _unplaned(zstandard.decompress(content), np.int64, n, 0)
                    met += 1
        if name is not None:
            yield close()

    return tx.released(run)


def weights(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, groups: int | None = None, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_features, weight (the floored mean of its features' gains, 0 without any).

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased; a null text has none. A bucket's gain
    is floor(1000 ln of its smoothed share among the target's features over that among docs'). Ids may be null or
    repeat; an empty table on either side counts as one without features; other columns are ignored.
    """
    conf = docs.sparkSession.conf
    parts = int(conf.get("spark.sql.shuffle.partitions"))
    groups = min(buckets, groups or parts)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    theirs = target.select(F.lit(None).cast("long").alias("doc_id"), F.col(target_col).cast("string").alias("text"))
    dealt = own.mapInArrow(_dealt(n, buckets, groups, False), _ROWS).unionByName(theirs.mapInArrow(_dealt(n, buckets, groups, True), _ROWS))
    met = dealt.repartitionById(groups, "part").sortWithinPartitions("kind").mapInArrow(_contributions(buckets, groups), _ROWS)
    by_slice = met.select("kind", F.struct("slice", "mark").alias("name"), "n", "content").repartition(parts, "name").sortWithinPartitions("name", "kind")
    return by_slice.select("kind", F.concat_ws(":", "name.slice", "name.mark").alias("name"), "n", "content").mapInArrow(_weights(groups), "doc_id long, n_words long, n_features long, weight long")


def resample(weighed: DataFrame, percent: int, least_words: int, seed: int) -> DataFrame:
    """weighed (as weights() gives it), with score and rank: doc_id, n_features, weight, score, rank.

    A document's score is its weight and 1000 times a Gumbel variable that its id and the seed fix, floored. Of the
    documents with least_words or more, `percent` per cent (rounded down) are drawn, the highest scores first, ties to
    the smaller id; the others' rank is null. A row without an id has no score, isn't drawn and doesn't count. Ranks
    are given over ranges of scores, so no task sees them all; rows of the same id and score are drawn in any order.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(weighed.withColumn("score", F.when(F.col("doc_id").isNotNull(), score).cast("long")))
    able = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    drawn = percent * scored.filter(able).count() // 100
    ranks = ordered.ranked(scored.filter(able), [F.col("score").desc(), F.col("doc_id").asc()])
    ranks = ranks.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    return ranks.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long"))).select("doc_id", "n_features", "weight", "score", "rank")
