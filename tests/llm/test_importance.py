"""Importance resampling, against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import importance, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text, n=2):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, Counter(" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1))


def _brute(docs, target, n=2, buckets=10_000, percent=25, least=20, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for total, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f, c in _features(text, n)[1].items():
                total[bucket(f)] += c
    big_s, big_t, out = sum(s.values()), sum(t.values()), []
    for i, text in docs:
        words, own = _features(text, n)
        gain = sum(c * math.floor(1000 * math.log((t[bucket(f)] + 1) * (big_s + buckets) / ((s[bucket(f)] + 1) * (big_t + buckets)))) for f, c in own.items())
        m = sum(own.values())
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        weight = gain // m if m else 0
        out.append([i, m, weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[0] is not None and r[5] >= least), key=lambda r: (-r[3], r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def _texts():
    rng = np.random.default_rng(8)
    vocab = ["é", "日本語", "A", "the", "x" * 47, "y" * 48, "z" * 49, "w" * 300, *(f"w{i}" for i in range(60))]
    texts = [" ".join(rng.choice(vocab, int(rng.integers(0, 60)))) for _ in range(60)]
    return texts + ["", None, "one", " ,.; ", " ".join(rng.choice(vocab, 20_000)), texts[3], texts[3]]


def test_weights_and_draws(spark):
    docs = [(100 - i, t) for i, t in enumerate(_texts())] + [(None, "a b c"), (99, _texts()[1])]
    target = _texts()[:7] + ["beyond all others", None]
    frame = spark.createDataFrame([(*d, 3, "k") for d in docs], "doc_id long, text string, n int, `kind.x` string").repartition(4)
    theirs = spark.createDataFrame([(t,) for t in target], "text string")
    for n, buckets in ((2, 10_000), (3, 50), (1, 7)):
        got = importance.resample(importance.weights(frame, theirs, n, buckets, groups=5), 25, 20, 7)
        assert sorted(map(tuple, got.collect()), key=str) == _brute(docs, target, n, buckets)


def test_empty_sides(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert importance.weights(frame.filter("false"), frame).count() == 0
    got = importance.resample(importance.weights(frame, frame.filter("false")), 50, 1, 7).collect()
    assert sorted((r.doc_id, r.weight) for r in got) == sorted((i, w) for i, _, w, *_ in _brute([(1, "a b"), (2, None)], [], least=1))


def test_query_on_whole_documents(spark):
    at = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{at}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{at}/benchmark.parquet").collect()]
    assert sorted(map(tuple, queries.op11_importance(spark, at).collect()), key=str) == _brute(docs, target)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=120).map(lambda b: b.replace(b" ", b"_")), min_size=1, max_size=6))
def test_crcs_of_runs(words):
    buf = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    own = importance.word_crcs(buf, starts, ends)
    assert own.tolist() == [zlib.crc32(w) for w in words]
    both = importance.longer(own[:-1], own[1:], buf, starts[1:], ends[1:])
    assert both.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:], strict=False)]
