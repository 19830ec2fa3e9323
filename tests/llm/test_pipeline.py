"""The corpus pipeline, stage by stage, against brute force; and its stages on odd rows."""

import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import bpe, toxicity
from tessera.llm.queries import CATEGORIES
from tests.llm.test_copies import _components, _fold, _line_brute, _set, _words

DIR = "/root/testdata/sf0.001"


def _leak_words(text):
    return [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _fold(text or ""))]


def _without_leaks(text, items, window=10, most=0.5):
    """The text without hit spans, or None if it goes."""
    words = _leak_words(text)
    own, hit = [w for *_, w in words], set()
    for item in items:
        w = [x for *_, x in _leak_words(item)]
        n = min(len(w), window)
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i : i + n]) in grams:
                hit |= set(range(i, i + n))
    if len(hit) > most * len(words):
        return None
    runs, out, at = sorted(hit), "", 0
    while runs:
        a = b = runs.pop(0)
        while runs and runs[0] == b + 1:
            b = runs.pop(0)
        out, at = out + text[at : words[a][0]], words[b][1]
    return (out + text[at:]) if hit else text


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near-dedup", "decontamination", "encoding"]

    got = [tuple(r) for r in stages[0](spark, docs, DIR).select("doc_id", "text").collect()]
    chain, _, _ = toxicity.train(docs, labels, CATEGORIES)
    fine = _plain_scores(chain, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted(i for i, _ in got) == sorted(i for i, p in fine.items() if p < chain.cuts[1])

    rows = sorted(got)
    now = spark.createDataFrame(rows, "doc_id long, text string")
    gone, _ = _line_brute(rows)
    want = []
    for i, t in rows:
        kept = "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
        if kept == t or _words(kept):
            want.append((i, kept))
    got = sorted(tuple(r) for r in stages[1](spark, now, DIR).collect())
    assert got == want

    now = spark.createDataFrame(got, "doc_id long, text string")
    sets = {i: _set(t, 5) for i, t in got}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    head = _components(ids, links)
    want = [r for r in got if head[r[0]] == r[0]]
    got = sorted(tuple(r) for r in stages[2](spark, now, DIR).collect())
    assert got == want

    items = [r.text for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    now = spark.createDataFrame(got, "doc_id long, text string")
    clean = [(i, _without_leaks(t, items)) for i, t in got]
    want = [r for r in clean if r[1] is not None]
    got = sorted(tuple(r) for r in stages[3](spark, now, DIR).collect())
    assert got == want

    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    last = {r.doc_id: (r.ids, r.decoded) for r in stages[4](spark, spark.createDataFrame(got, "doc_id long, text string"), DIR).collect()}
    assert last == {i: (enc.encode_ordinary(t), t) for i, t in got}
    whole = {r.doc_id: (r.ids, r.decoded) for r in corpus_pipeline.run(spark, DIR).select("doc_id", "ids", "decoded").collect()}
    assert whole == last


def _plain_scores(chain, rows):
    """The probability of the second category, word by word in plain Python, with the chain's own weights."""
    import math

    import numpy as np

    from tessera.llm import _text as tx
    from tessera.llm import linear

    def cell(word):
        raw = np.frombuffer(word, np.uint8)
        return int(tx.hashes(raw, np.array([0]), np.array([len(raw)]), tx.FOLDED)[0])

    out = {}
    for i, text in rows:
        cells = set()
        for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode()):
            cells.add(cell(w) >> (64 - linear.BITS))
            if len(w) > linear.STEM:
                cells.add(int(tx.mix(np.array([(cell(w[: linear.STEM]) + 9) % 2**64], np.uint64))[0]) >> (64 - linear.BITS))
        before = []
        for keep, w, links, bias in chain.models:
            weight = dict(zip(keep.tolist(), w.tolist(), strict=True))
            z = sum(weight.get(c, 0.0) for c in cells) + sum(a * b for a, b in zip(before, links.tolist(), strict=True)) + bias
            before.append(1 / (1 + math.exp(-min(40, max(-40, z)))))
        out[i] = before[1]
    return out


def test_stages_on_odd_rows(spark):
    kinds = "doc_id long, text string, n_chars int, gone string, gone_id long, _p0 double, _P1 int, row int, flags string, text_key int, kept boolean"
    long = " ".join(f"w{i}" for i in range(60_000))
    text = "A line of words that stands alone\nand another one with more of them"
    rows = [(None, "no id here at all", 1), (1, None, 1), (2, "", 1), (3, " \n\t", 1), (4, text, 1), (4, text, 1), (5, long, 1)]
    docs = spark.createDataFrame([(*r, "g", 2, 0.5, 3, 4, "f", 5, False) for r in rows], kinds)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR)
        if name == "encoding":
            assert sorted((r.doc_id is None, r.doc_id, r.decoded) for r in out.select("doc_id", "decoded").collect()) == sorted((i is None, i, t or "") for i, t, _ in rows)
        else:
            assert out.columns == docs.columns, name
            assert sorted(map(str, out.select("doc_id", "text", "gone", "_p0", "row").collect())) == sorted(map(str, docs.select("doc_id", "text", "gone", "_p0", "row").collect())), name
        assert stage(spark, docs.filter("false"), DIR).count() == 0
    assert {r.n for r in corpus_pipeline.drop_lines(spark, docs, DIR).filter("doc_id = 4").select(F.col("n_chars").alias("n")).collect()} == {len(text)}


def test_columns_of_any_name_and_ids_of_several_texts(spark):
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, long, 1, "x", "a"), (5, long, 2, "y", "b"), (5, other, 3, "z", "c"), (5, other, 3, "z", "d"), (7, other + " end", 4, "q", "e"), (None, long, 5, "n", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, ids string, `c0` string")
    stages = dict(corpus_pipeline.STAGES)
    assert sorted(r["c0"] for r in stages["near-dedup"](spark, docs, DIR).collect()) == ["a", "e", "f"]
    assert sorted(r["c0"] for r in stages["near-dedup"](spark, docs.filter("doc_id <> 7 or doc_id is null"), DIR).collect()) == ["a", "c", "d", "f"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR)
        if name == "encoding":
            assert set(out.columns) == {"doc_id", "n_tokens", "ids", "decoded", "a.b", "c0"} and {r["c0"]: (r["a.b"], r["decoded"]) for r in out.collect()} == {r[4]: (r[2], r[1]) for r in rows}
        else:
            assert out.columns == docs.columns and {r["a.b"] for r in out.collect()} <= {1, 2, 3, 4, 5}
