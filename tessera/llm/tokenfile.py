"""Token-id files: canonical length-limited Huffman coding of ids from global counts.

Format (a folder; Spark's own writers commit each part, so a lost task leaves nothing behind):
  codebook/  one Parquet row: lengths, a byte for each id of the vocabulary; canonical codes follow from them.
  blocks/    Parquet rows (shard, block, start, doc_ids, counts, checkpoints, payload), shards and blocks ascending in
             doc_id. A block decodes alone. Every document starts on a byte; `checkpoints` holds the bit length of each
             run of SEGMENT ids (the last of a document is shorter), so a reader can enter at any run.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm._spark import cut, shared_dir
from tessera.llm.bpe import tokenizer_encoder

MAX_BITS, SEGMENT = 18, 256
BLOCK_IDS, SHARD_IDS = 1 << 20, 8 << 20
_SLICE = 8 << 20


def lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most max_bits (package-merge); 0 for ids that don't occur."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids don't fit codes of {max_bits} bits")
    if n < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    own = counts[order].astype(np.float64)
    level, leaves = own[:0], []
    for _ in range(max_bits):
        k = len(level) // 2 * 2
        both = np.concatenate((own, level[0:k:2] + level[1:k:2]))
        by = np.argsort(both, kind="stable")
        leaves.append(by < n)
        level = both[by]
    take = 2 * n - 2
    for leaf in reversed(leaves):
        k = int(leaf[:take].sum())
        out[order[:k]] += 1
        take = 2 * (take - k)
    return out


def codes(sizes: np.ndarray) -> np.ndarray:
    """Canonical codes: ascending by length, then id."""
    out = np.zeros(len(sizes), np.uint32)
    used = np.flatnonzero(sizes)
    order = used[np.lexsort((used, sizes[used]))]
    if len(order):
        top = int(sizes.max())
        step = np.uint64(1) << (top - sizes[order].astype(np.uint64))
        out[order] = ((np.cumsum(step) - step) >> (top - sizes[order].astype(np.uint64))).astype(np.uint32)
    return out


def table(sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """What each run of `bits` bits starts with: id << 5 | length."""
    bits = max(1, int(sizes.max(initial=1)))
    used = np.flatnonzero(sizes)
    order = used[np.lexsort((used, sizes[used]))]
    return np.repeat(order.astype(np.uint32) << 5 | sizes[order], 1 << (bits - sizes[order].astype(np.int64))), bits


def pack(ids: np.ndarray, ends: np.ndarray, code: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all rows (row i's ids end at ends[i + 1]) and each row's byte ends; bit lengths of all runs and each row's run ends."""
    size = sizes[ids].astype(np.int64)
    at = np.concatenate(([0], np.cumsum(size)))
    n = np.diff(ends)
    row_bytes = np.concatenate(([0], np.cumsum((np.diff(at[ends]) + 7) // 8)))
    off = at[:-1] + np.repeat(row_bytes[:-1] * 8 - at[ends[:-1]], n)
    words = np.zeros(row_bytes[-1] // 8 + 2, np.uint64)
    if len(ids):
        word, left = off >> 6, 64 - (off & 63) - size  # free bits to the right in the word; below 0: it runs over
        c = code[ids].astype(np.uint64)
        over = left < 0
        head = np.where(over, c >> np.maximum(-left, 0).astype(np.uint64), c << np.maximum(left, 0).astype(np.uint64))
        lead = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        words[word[lead]] = np.bitwise_or.reduceat(head, lead)
        words[word[over] + 1] |= c[over] << (64 + left[over]).astype(np.uint64)
    runs = (n + SEGMENT - 1) // SEGMENT
    run_ends = np.concatenate(([0], np.cumsum(runs)))
    inner = np.arange(run_ends[-1]) - np.repeat(run_ends[:-1], runs)
    first = np.repeat(ends[:-1], runs) + inner * SEGMENT
    last = np.minimum(first + SEGMENT, np.repeat(ends[1:], runs))
    return words.byteswap().view(np.uint8)[: row_bytes[-1]], row_bytes, (at[last] - at[first]).astype(np.uint16), run_ends


def unpack(payload: np.ndarray, n: np.ndarray, bits_of: np.ndarray, lookup: np.ndarray, bits: int) -> np.ndarray:
    """The ids of a block: all its runs are decoded side by side, one id of each at a time."""
    ends = np.concatenate(([0], np.cumsum(n)))
    runs = (n + SEGMENT - 1) // SEGMENT
    run_ends = np.concatenate(([0], np.cumsum(runs)))
    total = np.concatenate(([0], np.cumsum(bits_of.astype(np.int64))))
    row_bytes = np.concatenate(([0], np.cumsum((np.diff(total[run_ends]) + 7) // 8)))
    inner = np.arange(run_ends[-1]) - np.repeat(run_ends[:-1], runs)
    pos = total[:-1] + np.repeat(row_bytes[:-1] * 8 - total[run_ends[:-1]], runs)
    out_at = np.repeat(ends[:-1], runs) + inner * SEGMENT
    count = np.minimum(SEGMENT, np.repeat(ends[1:], runs) - out_at)
    b = np.concatenate((payload, np.zeros(4, np.uint8))).astype(np.uint32)
    wide = b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]
    by = np.argsort(-count, kind="stable")
    pos, out_at, count = pos[by], out_at[by], count[by]
    live = np.searchsorted(-count, -np.arange(int(count.max(initial=0))), "left")  # runs of more ids than this
    out = np.empty(ends[-1], np.int32)
    mask = np.uint32((1 << bits) - 1)
    for step, k in enumerate(live.tolist()):
        p = pos[:k]
        got = lookup[(wide[p >> 3] >> (32 - bits - (p & 7)).astype(np.uint32)) & mask]
        out[out_at[:k] + step] = got >> 5
        p += got & 31
    return out


def _tokenize(path: str, end_id: int, recognise: bool):
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        encoder = tokenizer_encoder(path, recognise)
        kind = np.uint16 if len(encoder.widths) <= 1 << 16 else np.uint32
        for batch in batches:
            for lo, hi, buf, offs in tx.slices(batch.column(1), _SLICE):
                ids, n = encoder(buf, offs)
                ends = np.cumsum(n + 1)
                all_ids = np.full(int(ends[-1]), end_id, kind)
                inside = np.ones(len(all_ids), bool)
                inside[ends - 1] = False
                all_ids[inside] = ids
                blob = squeeze.compress(all_ids.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())), pa.array([(n + 1).tolist()], pa.list_(pa.int64())), pa.array([blob], pa.binary())], ["doc_ids", "counts", "ids"])

    return tx.released(run)


def _ids(blob: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), np.uint32 if wide else np.uint16)


def _tally(wide: bool, vocab: int):
    def run(batches):
        total = np.zeros(vocab, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.bincount(_ids(blob, wide), minlength=vocab)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return tx.released(run)


def _pack(wide: bool, book, bounds: np.ndarray):
    def run(batches):
        sizes = book.value
        code = codes(sizes)
        for batch in batches:
            for doc_ids, counts, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ends = np.concatenate(([0], np.cumsum(counts)))
                data, row_bytes, runs, run_ends = pack(_ids(blob, wide), ends, code, sizes)
                shard = np.searchsorted(bounds, [-(1 << 63) if d is None else d for d in doc_ids], "left")
                data, runs = data.tobytes(), runs.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.astype(np.int32)), pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()), pa.array([runs[2 * a : 2 * b] for a, b in zip(run_ends, run_ends[1:], strict=False)], pa.binary()), pa.array([data[a:b] for a, b in zip(row_bytes, row_bytes[1:], strict=False)], pa.binary())],
                    ["shard", "doc_id", "n", "runs", "data"],
                )

    return tx.released(run)


@tx.released
def _blocks(batches):
    """Rows of one shard, ascending, joined into blocks."""
    rows, n, start, block, shard = [], 0, 0, 0, None

    def close():
        ids, counts, runs, data = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((shard, pa.int32()), (block, pa.int64()), (start, pa.int64()), (list(ids), pa.list_(pa.int64())), (list(counts), pa.list_(pa.int64())), (b"".join(runs), pa.binary()), (b"".join(data), pa.binary()))], ["shard", "block", "start", "doc_ids", "counts", "checkpoints", "payload"])

    for batch in batches:
        for own, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and (own != shard or n >= BLOCK_IDS):
                yield close()
                start, block = (start + n, block + 1) if own == shard else (0, 0)
                rows, n = [], 0
            shard = own
            rows.append(row)
            n += row[1]
    if rows:
        yield close()


def _bounds(docs: DataFrame, shards: int) -> np.ndarray:
    """The largest doc_id of each shard but the last: ids alone are dealt by range, and the driver gets a number a shard."""
    if shards == 1:
        return np.zeros(0, np.int64)
    parts = docs.select("doc_id").repartitionByRange(shards, "doc_id").groupBy(F.spark_partition_id().alias("part")).agg(F.max("doc_id").alias("last")).collect()
    return np.array(sorted(r.last for r in parts if r.last is not None)[:-1], np.int64)


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, recognise: bool = False) -> None:
    """Encodes every text (a null one is empty) with a tokenizers file, ends it with end_id, and writes all ids to path in ascending order of the ids of the rows (null ids first, repeated ones side by side).

    With recognise, the file's added tokens become their ids where a text holds them, as is the library's default. A
    text of any length is one document of one block; an empty table gives files without blocks; other columns, whatever
    their names, are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    from tokenizers import Tokenizer

    vocab = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    wide = vocab > 1 << 16
    tokens = cut(docs.mapInArrow(_tokenize(tokenizer, end_id, recognise), "doc_ids array<long>, counts array<long>, ids binary"))
    found = np.zeros(vocab, np.int64)
    for row in tokens.select("ids").mapInArrow(_tally(wide, vocab), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # a row for each id of the vocabulary at most
        found[row.id] = row.n
    sizes = lengths(found)
    shards = max(1, -(-int(found.sum()) // SHARD_IDS))
    packed = tokens.mapInArrow(_pack(wide, spark.sparkContext.broadcast(sizes), _bounds(docs, shards)), "shard int, doc_id long, n long, runs binary, data binary")
    ordered = packed.repartitionById(shards, "shard").sortWithinPartitions("shard", "doc_id", "n", "data")
    out = ordered.mapInArrow(_blocks, "shard int, block long, start long, doc_ids array<long>, counts array<long>, checkpoints binary, payload binary")
    out.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark.createDataFrame([(sizes.tobytes(),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codebook")


def _unpack(book):
    def run(batches):
        lookup, bits = table(np.frombuffer(book.value, np.uint8))
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield row, unpack(np.frombuffer(row[6], np.uint8), np.array(row[4], np.int64), np.frombuffer(row[5], np.uint16), lookup, bits)

    return tx.released(run)


def _summary(book):
    decode = _unpack(book)

    def run(batches):
        for (shard, _, start, doc_ids, counts, *_), ids in decode(batches):
            ends = np.concatenate(([0], np.cumsum(counts)))
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array([shard] * len(doc_ids), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(start + ends[:-1]), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    return tx.released(run)


def _arrays(book):
    decode = _unpack(book)

    def run(batches):
        for (_, _, _, doc_ids, counts, *_), ids in decode(batches):
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["doc_id", "ids"])

    return tx.released(run)


def _open(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/blocks").select("shard", "block", "start", "doc_ids", "counts", "checkpoints", "payload"), spark.sparkContext.broadcast(bytes(spark.read.parquet(f"{path}/codebook").first().lengths))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (array of int, with the end id) of every document in the files."""
    blocks, book = _open(spark, path)
    return blocks.mapInArrow(_arrays(book), "doc_id long, ids array<int>")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold of each document: doc_id, start (ids before it), n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit integers)."""
    blocks, book = _open(spark, path)
    docs = blocks.mapInArrow(_summary(book), "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    sizes = blocks.select("shard", F.explode("counts").alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))  # a row a shard
    before = sizes.select(F.col("shard").alias("of"), F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return docs.join(before, F.col("shard") == F.col("of")).select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def new_path(spark: SparkSession) -> str:
    """A folder of its own in the shared storage."""
    return f"{shared_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
