"""Packing: places against the library's ids, numbers of sequences against the best possible."""

import functools
import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing, queries

FILE = P.path("byte_bpe_50k.json")


def _best(sizes, capacity):
    """The fewest sequences, by trying all ways to fill each with the longest piece that is left."""

    @functools.cache
    def least(left):
        if not left:
            return 0
        best = len(left)

        def fill(rest, room, kept):
            nonlocal best
            if not rest:
                best = min(best, 1 + least(kept))
                return
            if rest[0] <= room:
                fill(rest[1:], room - rest[0], kept)
            fill(rest[1:], room, (*kept, rest[0]))

        fill(left[1:], capacity - left[0], ())
        return best

    return least(tuple(sorted(sizes, reverse=True)))


def _bins(runs, n_bins, sizes, capacity):
    """The plan's sequences, after a look at each piece's place."""
    seen, bins = {}, [[] for _ in range(n_bins)]
    for r in runs:
        for i in range(r.n):
            assert seen.setdefault((r.length, r.first + i), r) is r
            bins[r.bin + i // r.each].append((r.offset + i % r.each * r.length, r.length))
    assert sorted(x for x, _ in seen) == sorted(sizes)
    assert all({i for y, i in seen if y == x} == set(range(sizes.count(x))) for x in set(sizes))
    for own in bins:
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    return bins


@settings(max_examples=250, deadline=None)
@given(st.integers(5, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=9))))
def test_plans_of_small_instances(case):
    capacity, sizes = case
    counts = np.bincount(sizes, minlength=capacity + 1) if sizes else np.zeros(capacity + 1, int)
    runs, n = packing.plan(counts)
    _bins(runs, n, sizes, capacity)
    best = _best(sizes, capacity)
    assert packing.bound(counts) <= best <= n <= best + 1


@settings(max_examples=250, deadline=None)
@given(st.integers(5, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), min_size=1, max_size=8))))
def test_what_is_fixed_is_in_some_best_packing(case):
    capacity, sizes = case
    own = packing._Lengths(np.bincount(sizes, minlength=capacity + 1))
    for length in set(sizes):
        more = packing._dominating(own, length, capacity)
        if more is not None:
            rest = list(sizes)
            for x in (length, *more):
                rest.remove(x)
            assert 1 + _best(rest, capacity) == _best(sizes, capacity)


def test_a_large_instance_is_close_to_the_bound():
    counts = np.zeros(2049, np.int64)
    rng = np.random.default_rng(2)
    for x in np.clip(rng.lognormal(6, 1, 200_000), 1, 2048).astype(int):
        counts[x] += 1
    runs, n = packing.plan(counts)
    assert sum(r.n for r in runs) == counts.sum() and n <= 1.002 * packing.bound(counts) and len(runs) < 40_000


def _check(rows, docs, capacity):
    tok = Tokenizer.from_file(FILE)
    ids = [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for _, t in docs]
    want = []
    for (i, _), own in zip(docs, ids, strict=True):
        lead = (len(own) - 1) % capacity + 1
        cuts = [0, *range(lead, len(own) + 1, capacity)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(own[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id is not None) == sorted(w for w in want if w[0] is not None)
    assert len(rows) == len(want)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_documents_are_packed(spark):
    texts = ["", None, "a", "one two three " * 40, "x" * 5000, "é日本 " * 300, "<|endoftext|> b", "a b c d e f", "a b c d e f", *(" ".join(["word"] * k) for k in range(1, 90))]
    docs = [(None if k == 7 else 50 - k, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, length string, `a.part` int").repartition(3)
    rows = packing.pack(frame, FILE, 64, recognise=True, with_ids=True)
    _check(rows.collect(), docs, 64)
    whole = packing.sequences(rows).collect()
    assert all(len(r.ids) == r.length <= 64 for r in whole) and sum(r.length for r in whole) == sum(len(r.ids) for r in rows.collect())
    assert packing.pack(frame.filter("false"), FILE, 64).count() == 0


def test_query_on_whole_documents(spark):
    at = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    rows = queries.op13_packing(spark, at).collect()
    n = _check(rows, docs, 2048)
    counts = np.bincount([r.length for r in rows], minlength=2049)
    assert n <= packing.bound(counts) + 1
