"""Operators without SQL, against plain-Python versions of the same definitions."""

import math
import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import _text as tx
from tessera.llm import chunkdedup, linear, linededup, minhash, pii, quality, queries, toxicity
from tests.llm.test_pipeline import _plain_scores

# The patterns of the base spans.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["a", "B9", "1", "25", "255", "256", "007", ".", "@", "+", "-", " ", "(", ")", "%", "é", "x@y.z", "1.2.3.4", "4111 1111-1111 1111", "+1 (988) 555-2485", "\n"]), max_size=25).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    want = [(m.start(), m.end(), k) for k, kind in enumerate(pii.KINDS) for m in re.finditer(BASE[kind], text) if _holds(kind, m[0])]
    assert pii.base(text) == sorted(want, key=lambda x: (x[0], x[2]))


def _rounds(edges):
    """The bootstrap on dictionaries: (inst, kind or -1, pat) to what joins."""
    known, links, of = defaultdict(dict), defaultdict(set), defaultdict(set)
    for inst, kind, pat in edges:
        links[inst].add(pat)
        of[pat].add(inst)
        if kind >= 0:
            known[inst][kind] = 1.0
    added = {}
    while True:
        trust = {}
        for pat, own in of.items():
            for kind in range(len(pii.KINDS)):
                confs = [known[i][kind] for i in own if i in known and kind in known[i]]
                if len(confs) >= pii.SUPPORT and sum(confs) / (len(own) + 0.5) >= pii.PATTERN:
                    trust[pat, kind] = sum(confs) / (len(own) + 0.5)
        new = {}
        for inst in links.keys() - known.keys():
            scores = [(1 - math.prod(1 - min(0.999, trust[p, k]) for p in links[inst] if (p, k) in trust), -k) for k in range(len(pii.KINDS))]
            conf, kind = max(scores)
            if conf >= pii.INSTANCE:
                new[inst] = (-kind, conf)
        if not new:
            return added
        for inst, (kind, conf) in new.items():
            known[inst] = {kind: conf}
            added[inst] = kind


def test_bootstrap_runs_to_the_end(spark):
    rng = np.random.default_rng(2)
    edges = {(i, i // 10 % 2, 1000 + i // 10 % 2) for i in range(60)}
    for step in range(8):  # each step's instances are all that the next one's patterns know
        edges |= {(100 + 20 * step + j, -1, 1000 + (1 if step == 0 else 10 * step)) for j in range(20)} if step == 0 else {(80 + 20 * step + j, -1, 1000 + 10 * step) for j in range(20)} | {(100 + 20 * step + j, -1, 1000 + 10 * step) for j in range(3)}
    edges |= {(int(rng.integers(0, 400)), -1, int(rng.integers(2000, 2030))) for _ in range(300)}
    edges |= {(500 + i, 0, 5000) for i in range(50)} | {(600 + i, -1, p) for i in range(5) for p in (5000, 5001)} | {(500 + i, 0, 5001) for i in range(50)}
    edges |= {(605 + i, -1, 5002) for i in range(2)} | {(600 + i, -1, 5002) for i in range(5)}
    got = dict(map(tuple, pii.bootstrap(spark.createDataFrame(sorted(edges), "inst long, kind int, pat long")).collect()))
    assert got == _rounds(edges) and len(got) >= 5
    assert pii.bootstrap(spark.createDataFrame([], "inst long, kind int, pat long")).count() == 0


def _passages(rows, least):
    """(words, repeated words, removed words) of each text, comparing the words of all chunks with one another."""
    own = {}
    for i, text in rows:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        starts, ends, _, edge, *_ = chunkdedup.chunks(raw, np.array([0, len(raw)]))
        words = [raw[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        own[i] = [tuple(words[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)] if words else []
    out = {}
    for i, mine in own.items():
        elsewhere = [any(c in other for j, other in own.items() if j != i) for c in mine]
        before = [any(c in other for j, other in own.items() if j < i) or c in mine[:k] for k, c in enumerate(mine)]
        twice = [e or mine.count(c) > 1 for c, e in zip(mine, elsewhere, strict=True)]
        out[i] = (sum(map(len, mine)), _long(twice, mine, least), _long(before, mine, least))
    return out


def _long(flags, parts, least):
    total = run = 0
    for f, c in [*zip(flags, parts, strict=True), (False, ())]:
        if f:
            run += len(c)
        else:
            total, run = total + (run if run >= least else 0), 0
    return total


def test_passages_match_a_comparison_of_all_chunks(spark):
    rng = np.random.default_rng(8)
    vocab = [f"word{i}" for i in range(3000)]
    shared = [" ".join(rng.choice(vocab, n)) for n in (15, 40, 60, 90)]
    rows = [(0, None), (1, ""), (2, "one")]
    for i in range(3, 40):
        parts = [" ".join(rng.choice(vocab, rng.integers(0, 80))) for _ in range(3)]
        for _ in range(rng.integers(0, 3)):
            parts.insert(int(rng.integers(0, 4)), shared[rng.integers(0, 4)])
        rows.append((i, "\n".join(parts)))
    rows.append((40, shared[3] + " " + shared[3]))
    got = {r.doc_id: (r.n_words, r.n_repeated, r.n_removed) for r in chunkdedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = _passages(rows, chunkdedup.MIN_WORDS)
    assert got == want and sum(r > 0 for *_, r in want.values()) > 10


def test_quality_scores_follow_the_model(spark):
    at = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    views = quality.train(docs, labels, "quality")
    table, meta_w, mean, sd, dense, scale, mix = views.packed()
    got = {r.doc_id: r for r in quality._scored(quality._named(docs, "doc_id", "text", ("source", "lang")), views).collect()}
    for r in docs.select("doc_id", "text", "source", "lang").collect()[:60]:
        raw = np.frombuffer((r.text or "").encode(), np.uint8)
        offs = np.array([0, len(raw)])
        cell, _ = linear.cells(raw, offs)
        meta = quality._meta([[r.source], [r.lang]], np.array([len(raw)]), np.array([(r.text or "").count("\n")]))[0]
        z = [sum(table[c] for c in set(cell.tolist())) + float((quality._shape(raw, offs)[0] - mean) / sd @ dense[0][:-1]) + dense[0][-1], sum(meta_w[m] for m in set(meta.tolist())) + dense[1][-1]]
        z = [min(30, max(-30, z[v])) * scale[v][0] + scale[v][1] for v in (0, 1)]
        p = [1 / (1 + math.exp(-x)) for x in (*z, z[0] * mix[0] + z[1] * mix[1] + mix[2])]
        assert np.allclose(p, (got[r.doc_id].p_text, got[r.doc_id].p_metadata, got[r.doc_id].p_quality))


def _probabilities(views, features):
    """Each view's answer for one document's features, in plain arithmetic."""
    table, meta_w, mean, sd, dense, scale, _ = views.packed()
    cells, shape, meta = features
    z = [sum(table[c] for c in sorted(set(cells.tolist()))) + float((shape - mean) / sd @ dense[0][:-1]) + dense[0][-1], sum(meta_w[m] for m in sorted(set(meta.tolist()))) + dense[1][-1]]
    return [1 / (1 + math.exp(-(min(30, max(-30, z[v])) * scale[v][0] + scale[v][1]))) for v in (0, 1)]


def test_views_exchange_the_surest_of_all(spark):
    at, handed = "/root/testdata/sf0.001", 12
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    got = quality.train(docs, labels, "quality", handed=handed)
    features = {}
    for r in docs.select("doc_id", "text", "source", "lang").collect():
        raw = np.frombuffer((r.text or "").encode(), np.uint8)
        offs = np.array([0, len(raw)])
        cell, _, shape, meta = quality._views(raw, offs, [[r.source], [r.lang]])
        features[r.doc_id] = cell, shape[0], meta[0]
    known = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in features}
    gather = lambda ids: ([features[i][0] for i in ids], np.array([features[i][1] for i in ids]).reshape(len(ids), 7), [features[i][2] for i in ids])
    first = sorted(known)
    views = quality.Views(*gather(first), np.array([known[i] for i in first]))
    given, met = set(), 0
    for _ in range(quality.ROUNDS):
        pool = {i: _probabilities(views, f) for i, f in features.items() if i not in known and i not in given}
        high = round(handed * views.rate)
        for v in (0, 1):
            sure = [(i, 1) for i in sorted((i for i, p in pool.items() if p[v] > 0.9), key=lambda i: (-pool[i][v], i))[:high]]
            sure += [(i, 0) for i in sorted((i for i, p in pool.items() if p[v] < 0.1), key=lambda i: (pool[i][v], i))[: handed - high]]
            met += len({pool[i][v] for i in pool}) < len(pool)  # some are alike, and the smaller id goes first
            if sure:
                given |= {i for i, _ in sure}
                label = dict(sure)
                views.hand(1 - v, *gather(sorted(label)), np.array([float(label[i]) for i in sorted(label)]))
        views.fit()
    views.finish()
    assert met and given and views.handed == got.handed
    for a, b in zip(views.packed(), got.packed(), strict=True):
        assert all(np.allclose(x, y, atol=1e-6) for x, y in zip(a, b, strict=True)) if isinstance(a, list) else np.allclose(a, b, atol=1e-6)


def test_toxicity_query_word_by_word(spark):
    at = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    chain, _, _ = toxicity.train(docs, labels, queries.CATEGORIES)
    plain = _plain_scores(chain, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: r for r in queries.op7_toxicity(spark, at).collect()}
    assert got.keys() == plain.keys() and any(r.rejected for r in got.values())
    assert all(abs(got[i].p_toxic - p) < 1e-9 and got[i].rejected == (p >= chain.cuts[1]) for i, p in plain.items())


def test_very_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(1, "a b c d e f g"), (2, long), (3, long + " end"), (4, long + "\n" + long), (5, "w" * 400_000), (6, "\n" * 200_000)]
    docs = spark.createDataFrame([(*r, "s", "en") for r in rows], "doc_id long, text string, source string, lang string")
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert near[2] == (119_996, 2) and near[3] == (119_997, 2) and near[4][1] == 2 and near[5] == (1, 5) and near[6] == (0, 6)
    lines = {r.doc_id: (r.n_lines, r.n_removed) for r in linededup.dedup_lines(docs).collect()}
    assert lines == {1: (1, 0), 2: (1, 0), 3: (1, 1), 4: (2, 2), 5: (1, 0), 6: (200_001, 0)}
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (5, 0, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs, labels, queries.CATEGORIES, "toxic").count() == 6
    assert quality.score(docs, labels).filter("p_quality between 0 and 1").count() == 6


def test_hashes_hold_against_structure():
    a, b = b"a", b"b"
    for _ in range(11):  # words of 2048 letters whose sums of powers are alike modulo 2**64
        a, b = a + b, b + a
    raw = np.frombuffer(a + b, np.uint8)
    h = tx.hashes(raw, np.array([0, len(a)]), np.array([len(a), len(raw)]))
    assert h[0] != h[1]
    words = [b"x" * n for n in range(1, 130)] + [b"y" + b"x" * n for n in range(130)]
    raw, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    h = tx.hashes(raw, np.concatenate(([0], ends[:-1])), ends)
    assert len(set(h.tolist())) == len(words)
    alone = [int(tx.hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words]
    assert alone == h.tolist()  # wherever a span stands
