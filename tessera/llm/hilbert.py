"""Nearest neighbours by inner product from several shifted Hilbert orderings.

Vectors are projected to a few dimensions, in CURVES ways, shifted, and ordered by their keys on a Hilbert curve. Spark
range-partitions each ordering; around each query's key, a window of neighbours is merged over the orderings and ranked
by the exact measure. On data without low-dimensional structure windows alone can't find nine in ten neighbours, so an
exact completion follows: blocks of neighbouring keys, each with a centre and a radius, are skipped where their bound
on the inner product lies under a query's 20th score so far, and read in full where it doesn't.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm._spark import cut

#: Orderings, dimensions and bits of a key, neighbours on either side, rows in a block of an ordering, rows in blocks of data and of queries in the completion.
CURVES, DIMS, BITS, REACH, BLOCK, DATA, ASKED = 4, 8, 7, 128, 4096, 8192, 1024


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Keys on the Hilbert curve of integer points (n, d), each coordinate under 2**bits: axes to transposed index, then interleaved."""
    x = x.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            on = (x[i] & q) > 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[d - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> b) & 1
    return key


def _curve_keys(v: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """(n, CURVES) keys of unit-scaled vectors with one more coordinate."""
    n, d = v.shape
    full = np.column_stack((v, extra))
    out = np.empty((n, CURVES), np.int64)
    for c in range(CURVES):
        rng = np.random.default_rng(1000 + c)
        basis = np.linalg.qr(rng.standard_normal((d + 1, min(DIMS, d + 1))))[0]
        spread = 3 / np.sqrt(d)
        y = (full @ basis / spread + 1 + rng.random(basis.shape[1]) * 0.5) / 2.5
        out[:, c] = hilbert(np.clip((y * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1), BITS)
    return out


def _matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy().reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def _keyed(top: float, every: int):
    """A row for each vector and curve, and for each query and curve: (curve, key, query, vec_id, v)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ids, v = part.column(0).to_numpy(), _matrix(part.column(1))
                norm = np.sqrt((v * v).sum(1))
                keys = _curve_keys(v / top, np.sqrt(np.maximum(0, 1 - (norm / top) ** 2)))
                asked = np.flatnonzero(ids % every == 0)
                q = _curve_keys(v[asked] / norm[asked, None], np.zeros(len(asked)))
                for c in range(CURVES):
                    n = len(ids) + len(asked)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, c, np.int32)), pa.array(np.concatenate((keys[:, c], q[:, c]))), pa.array(np.arange(n) >= len(ids)), pa.array(np.concatenate((ids, ids[asked]))), pa.concat_arrays([part.column(1), part.column(1).take(pa.array(asked))])], ["curve", "key", "query", "vec_id", "v"])

    return tx.released(run)


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each row summed alike wherever it stands."""
    return (q * v).sum(1)


def _best(q: np.ndarray, q_ids: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int, allowed=None):
    """(query, vector, score) of each query's k best rows, more on ties."""
    rough = q @ v.T
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    if allowed is not None:
        rough[~allowed] = -np.inf
    if len(ids) > k:
        floor = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
        rough[rough < (floor - 1e-9 * (1 + np.abs(floor)))[:, None]] = -np.inf
    a, b = np.nonzero(np.isfinite(rough))
    s = scores(q[a], v[b])
    by = np.lexsort((ids[b], -s, a))
    a, b, s = a[by], b[by], s[by]
    first = np.searchsorted(a, np.arange(len(q)))
    few = np.arange(len(a)) - first[a] < k
    return q_ids[a[few]], ids[b[few]], s[few]


def _windows(k: int):
    def run(table: pa.Table) -> pa.Table:
        rank, query, ids, v = table.column("rank").to_numpy(), table.column("query").to_numpy(zero_copy_only=False), table.column("vec_id").to_numpy(), _matrix(table.column("v"))
        here, asked = np.flatnonzero(~query), np.flatnonzero(query)
        out = []
        for a in range(0, len(asked), 256):
            own = asked[a : a + 256]
            near = np.abs(rank[own][:, None] - rank[here][None, :]) <= REACH
            some = near.any(0)
            out.append(_best(v[own], ids[own], v[here[some]], ids[here[some]], k, near[:, some]))
        cols = [np.concatenate(x) if out else np.zeros(0) for x in (zip(*out, strict=True) if out else [()] * 3)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    return run


def _packed(table: pa.Table) -> pa.Table:
    """A block of data vectors as one row, with its centre and radius."""
    ids, v = table.column("vec_id").to_numpy(), _matrix(table.column("v")).astype(np.float64)
    centre = v.mean(0)
    radius = float(np.sqrt(((v - centre) ** 2).sum(1).max()))
    return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()), "ids": [ids.tobytes()], "vectors": [v.tobytes()], "centre": [centre.tobytes()], "radius": [radius]})


def _asked(table: pa.Table) -> pa.Table:
    """A block of queries as one row, with their scores to beat."""
    ids, v = table.column("vec_id").to_numpy(), _matrix(table.column("v")).astype(np.float64)
    return pa.table({"asked": pa.array([table.column("asked")[0].as_py()], pa.int64()), "q_ids": [ids.tobytes()], "q_vectors": [v.tobytes()], "floors": [table.column("floor").to_numpy().astype(np.float64).tobytes()]})


def _needs(q: np.ndarray, floors: np.ndarray, centre: bytes, radius: float) -> np.ndarray:
    bound = q @ np.frombuffer(centre) + np.sqrt((q * q).sum(1)) * radius
    return bound * (1 + 1e-9 * np.sign(bound)) + 1e-12 >= floors


@tx.released
def _open_pairs(batches):
    """(block, asked) whose bound leaves a query open."""
    for batch in batches:
        keep = []
        for q, floors, centre, radius in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
            f = np.frombuffer(floors)
            keep.append(bool(_needs(np.frombuffer(q).reshape(len(f), -1), f, centre, radius).any()))
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], ["block", "asked"])


def _completed(k: int):
    def run(batches):
        for batch in batches:
            for ids, vectors, centre, radius, q_ids, q, floors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, q_ids, floors = np.frombuffer(ids, np.int64), np.frombuffer(q_ids, np.int64), np.frombuffer(floors)
                v, q = np.frombuffer(vectors).reshape(len(ids), -1), np.frombuffer(q).reshape(len(q_ids), -1)
                need = np.flatnonzero(_needs(q, floors, centre, radius))
                for a in range(0, len(need), 256):
                    own = need[a : a + 256]
                    x, y, s = _best(q[own], q_ids[own], v, ids, k)
                    yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(s)], ["query_id", "vec_id", "score"])

    return tx.released(run)


def _ranked(df: DataFrame, *order: str) -> DataFrame:
    """df with the column rank, from 0, by `order`: sorted range partitions, whose sizes (a row a partition) give the rest."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    rows = rows.withColumn("part", F.shiftright("at", 33))
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(before, F.col("part") == F.col("of")).withColumn("rank", F.col("at") - F.shiftleft("part", 33) + F.col("before")).drop("at", "part", "of", "before")


def _top(found: DataFrame, k: int) -> DataFrame:
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter("vec_id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(v, x -> x <> 0)")
    sizes = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return v.filter(F.size("v") == (sizes.d if sizes else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def neighbours(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", complete: bool = True) -> DataFrame:
    """The k vectors of largest inner product for each vector whose id is divisible by `every`: query_id, rank, vec_id, score.

    Nearest first, ties to the smaller id; all others, if fewer than k. Vectors that are null, empty, zero or hold a
    null or non-finite component take no part, nor do those of another dimension than most have (of several as
    frequent, the largest), nor null ids. Of rows that share an id, the smallest vector counts. An empty table gives an
    empty result; other columns are ignored. complete=False leaves out the exact completion.
    """
    v = cut(valid(vectors, id_col, vector_col))
    top = v.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    if top is None:
        return v.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fields = "query_id long, vec_id long, score double"
    rows = _ranked(v.mapInArrow(_keyed(top, every), "curve int, key long, query boolean, vec_id long, v array<double>"), "curve", "key", "vec_id", "query")
    spots = F.when(F.col("query"), F.array_distinct(F.array(F.expr(f"greatest(rank - {REACH}, 0L) div {BLOCK}"), F.expr(f"rank div {BLOCK}"), F.expr(f"(rank + {REACH}) div {BLOCK}")))).otherwise(F.array(F.expr(f"rank div {BLOCK}")))
    found = cut(_top(rows.withColumn("block", F.explode(spots)).select("block", "rank", "query", "vec_id", "v").groupBy("block").applyInArrow(_windows(k), fields), k).select("query_id", "vec_id", "score"))
    if complete:
        floors = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).select("query_id", F.when(F.col("n") >= k, F.col("s")).otherwise(F.lit(float("-inf"))).alias("floor"))
        first = rows.filter("curve = 0")
        data = cut(first.filter("not query").withColumn("block", F.expr(f"rank div {DATA}")).select("block", "vec_id", "v").groupBy("block").applyInArrow(_packed, "block long, ids binary, vectors binary, centre binary, radius double"))
        asked = first.filter("query").select("rank", F.col("vec_id"), "v").join(floors.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        asked = cut(asked.withColumn("asked", F.expr(f"rank div {ASKED * every}")).select("asked", "vec_id", "v", "floor").groupBy("asked").applyInArrow(_asked, "asked long, q_ids binary, q_vectors binary, floors binary"))
        most = asked.agg(F.max("asked")).first()[0]
        if most is not None:
            # The query set against all rows, in blocks: first by bounds alone, then the vectors of the blocks left.
            pairs = data.select("block", "centre", "radius", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most).cast("long"))).alias("asked")).join(asked.select("asked", "q_vectors", "floors"), "asked")
            pairs = cut(pairs.select("block", "asked", "q_vectors", "floors", "centre", "radius").mapInArrow(_open_pairs, "block long, asked long"))
            full = pairs.join(data, "block").join(asked, "asked").select("ids", "vectors", "centre", "radius", "q_ids", "q_vectors", "floors")
            found = found.unionByName(full.mapInArrow(_completed(k), fields))
    return _top(found, k).select("query_id", "rank", "vec_id", "score")
