"""MinHash near-duplicate detection: one-permutation hashing, optimal densification, bands, star-shaped candidate edges.

Links are confirmed on whole shingle sets with integer arithmetic (den * intersection >= num * union), so a false
candidate never links two documents. In each bucket the member that shares most buckets with others, which in a group
of near copies is the one most like the rest, is the centre of a star of candidate edges. A centre has been held
against its whole bucket and leaves it; while a bucket has members in different components, it gets a new star, ROUNDS
times. What then lies apart in one bucket is compared in pairs, first by bounds that no link exceeds: the sizes, and the
parities of the sets over PARITY classes of hashes, which differ in no more classes than the sets differ in shingles. A
true link is therefore missed only if the pair shares no band: at 0.8 with odds of 1.6e-9 if bins were independent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm._spark import components, cut

U = np.uint64
BINS, ROWS = 256, 5
BANDS = BINS // ROWS
#: Classes of shingle hashes whose parities a set's map holds.
PARITY = 1024
WORDS = PARITY // 64
ROUNDS = 3


_MAP = [f"f{j}" for j in range(WORDS)]


def _probes(bins: int, tries: int) -> np.ndarray:
    """The bins that each empty bin asks, one after another; the same for every document."""
    return (tx.mix(np.arange(bins * tries, dtype=U) * U(0x9E3779B97F4A7C15) + U(77)) % U(bins)).astype(np.int64).reshape(bins, tries)


_PROBES = _probes(BINS, 512)
_BAND = tx.seeds(ROWS, 31)


def signatures(u: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One-permutation signature of each non-empty row of sorted hashes: the least in each of BINS bins by their leading bits; an empty bin copies the first non-empty bin of its own probe sequence."""
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    key = row * BINS + (u >> U(56)).astype(np.int64)
    lead = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    flat, full = np.zeros(n * BINS, U), np.zeros(n * BINS, bool)
    flat[key[lead]], full[key[lead]] = u[lead], True
    todo = np.flatnonzero(~full & np.repeat(np.diff(first) > 0, BINS))
    for t in range(_PROBES.shape[1] + BINS):
        if not len(todo):
            break
        own = todo % BINS
        step = _PROBES[own, t] if t < _PROBES.shape[1] else (own + 1 + t - _PROBES.shape[1]) % BINS
        ask = todo - own + step
        hit = full[ask]
        flat[todo[hit]] = flat[ask[hit]]
        todo = todo[~hit]
    return flat.reshape(n, BINS)


def parities(u: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each row of sorted hashes, which of PARITY classes hold an odd number of them, as bits of WORDS words."""
    n = len(first) - 1
    key = np.repeat(np.arange(n), np.diff(first)) * PARITY + (tx.mix(u) & U(PARITY - 1)).astype(np.int64)
    odd = np.bincount(key, minlength=n * PARITY) & 1
    return np.packbits(odd.astype(bool).reshape(n, PARITY), axis=1).view(np.int64)


def _sign(k: int):
    def run(batches):
        for batch in batches:
            for lo, hi, buf, offs in tx.slices(batch.column(1)):
                starts, ends, first = tx.spans(buf, offs, tx.SOLID)
                u, at = tx.shingles(tx.hashes(buf, starts, ends, tx.FOLDED), first, k)
                n = np.diff(at)
                sig = signatures(u, at)
                bands = np.zeros((hi - lo, BANDS), U)
                for j in range(ROWS):
                    bands += sig[:, j : BANDS * ROWS : ROWS] * _BAND[j]
                bands = tx.mix(bands + np.arange(1, BANDS + 1, dtype=U) * U(0x632BE59BD9B4E019))
                keep = np.flatnonzero(n > 0)
                sums = [np.zeros(hi - lo, U), np.zeros(hi - lo, U)]
                for s, salt in zip(sums, (U(5), U(1 << 40)), strict=True):
                    if len(keep):
                        s[keep] = np.add.reduceat(tx.mix(u + salt), at[keep])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(n > 0, BANDS, 0)))).astype(np.int32)), pa.array(bands[keep].reshape(-1).view(np.int64)))
                flags = parities(u, at)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n), *(pa.array(x.view(np.int64)) for x in sums), lists, *(pa.array(np.ascontiguousarray(flags[:, j])) for j in range(WORDS))], ["doc_id", "n_shingles", "set_a", "set_b", "bands", *_MAP])

    return tx.released(run)


def _confirm(k: int, num: int, den: int):
    def sets(col, lo, hi, known):
        """Shingle sets of rows lo to hi; a text that repeats in a row is read once."""
        out = []
        for x in col.slice(lo, hi - lo).to_pylist():
            if x != known[0]:
                raw = np.frombuffer(x.encode(), np.uint8)
                starts, ends, first = tx.spans(raw, np.array([0, len(raw)]), tx.SOLID)
                known[:] = x, tx.shingles(tx.hashes(raw, starts, ends, tx.FOLDED), first, k)[0]
            out.append(known[1])
        return out

    def run(batches):
        last = [None, None]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                hi = min(batch.num_rows, lo + 256)
                ok = []
                for a, b in zip(sets(batch.column(2), lo, hi, last), sets(batch.column(3), lo, hi, [None, None]), strict=True):
                    least, most = sorted((len(a), len(b)))
                    both = 0
                    if den * least >= num * most:
                        both = len(a) + len(b) - len(np.unique(np.concatenate((a, b))))
                    ok.append(den * both >= num * (len(a) + len(b) - both))
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(lo, hi - lo).filter(pa.array(ok)) for i in (0, 1)], ["hi", "lo"])

    return tx.released(run)


def _confirmed(pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (hi, lo) that are links by their whole texts."""
    used = pairs.select(F.col("hi").alias("id")).unionByName(pairs.select(F.col("lo").alias("id"))).distinct()
    texts = docs.join(used, docs.doc_id == used.id, "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    a = texts.select(F.col("doc_id").alias("lo_id"), F.col("text").alias("lo_text"))
    b = texts.select(F.col("doc_id").alias("hi_id"), F.col("text").alias("hi_text"))
    both = pairs.join(b, F.col("hi") == F.col("hi_id")).join(a, F.col("lo") == F.col("lo_id"))
    return both.select("hi", "lo", "lo_text", "hi_text").mapInArrow(_confirm(k, num, den), "hi long, lo long")


def _candidates(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (hi, lo) that share a bucket, lie in different parts and may be links, from rows (bucket, rep, part, n_shingles and the map of parities)."""
    x, y = (rows.select("bucket", F.col("rep").alias(r), F.col("part").alias(f"{r}_part"), *(F.col(f).alias(f"{r}_{f}") for f in ("n_shingles", *_MAP))) for r in ("hi", "lo"))
    flips = " + ".join(f"bit_count(hi_{f} ^ lo_{f})" for f in _MAP)
    # Sets a and b with Jaccard num/den or more differ in (den - num) / (den + num) of a + b shingles at most.
    near = f"{den} * least(hi_n_shingles, lo_n_shingles) >= {num} * greatest(hi_n_shingles, lo_n_shingles) and {num + den} * ({flips}) <= {den - num} * (hi_n_shingles + lo_n_shingles)"
    return x.join(y, "bucket").filter(f"hi > lo and hi_part <> lo_part and {near}").select("hi", "lo").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    Words are runs without ASCII white space, with A-Z lower-cased; a document's set holds its distinct word shingles,
    or its whole word sequence if shorter. A null, empty or blank text has an empty set, is linked with nothing and is
    its own component. A null id gives null component and is kept. Rows that share an id and a text are one document
    and get the same answer; if one id has several texts, each row's set counts by its own text and a link is held
    against the smallest of the texts. An empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sig = cut(docs.mapInArrow(_sign(shingle), "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, " + ", ".join(f"{c} long" for c in _MAP)))
    own = sig.filter("n_shingles > 0 and doc_id is not null")
    # Equal sets are one node from here on: a group of copies costs one row, whatever its size.
    first = [F.first(c).alias(c) for c in ("n_shingles", "bands", *_MAP)]
    reps = cut(own.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), *first))
    bands = reps.select("rep", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = bands.join(shared, "bucket").select("bucket", "rep", "n")
    liked = members.groupBy("rep").agg(F.sum("n").alias("liked"))
    members = cut(members.drop("n").join(liked, "rep").select("bucket", "rep", "liked", F.col("rep").alias("part")))
    tried = links = comp = None
    for _ in range(ROUNDS):
        centres = members.groupBy("bucket").agg(F.max(F.struct("liked", (-F.col("rep")).alias("r"))).alias("c"), F.min("part").alias("p"), F.max("part").alias("q")).filter("p < q").select("bucket", (-F.col("c.r")).alias("centre"))
        # Buckets all in one component, and centres, have nothing left to show.
        star = cut(members.join(centres, "bucket").filter("rep <> centre").select("bucket", "rep", "liked", "part", "centre"))
        pairs = star.select(F.greatest("rep", "centre").alias("hi"), F.least("rep", "centre").alias("lo")).distinct()
        pairs = cut(pairs if tried is None else pairs.join(tried, ["hi", "lo"], "left_anti"))
        if pairs.isEmpty():
            break
        new = cut(_confirmed(pairs, docs, shingle, num, den))
        tried, links = (pairs, new) if tried is None else (tried.unionByName(pairs), links.unionByName(new))
        comp = cut(components(links))
        members = cut(star.drop("part").join(comp, star.rep == comp.node, "left").select("bucket", "rep", "liked", F.coalesce("component", "rep").alias("part")))
    if comp is None:
        comp = own.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("component")).filter("false")
    else:
        mixed = members.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p < q").select("bucket")
        maps = reps.select("rep", "n_shingles", *_MAP)
        open_ = cut(members.join(mixed, "bucket").select("bucket", "rep", "part").join(maps, "rep"))
        more = _candidates(open_, num, den)
        more = cut(more.join(tried, ["hi", "lo"], "left_anti"))
        if not more.isEmpty():
            comp = cut(components(links.unionByName(cut(_confirmed(more, docs, shingle, num, den)))))
    named = reps.select("set_a", "set_b", "rep").join(comp, F.col("rep") == F.col("node"), "left").select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id"))
    out = sig.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    out = out.withColumn("component_id", F.expr("case when doc_id is null then null when n_shingles = 0 then doc_id else component_id end"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
