"""Many keywords in one pass, against counting one by one."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import keywords as K
from tessera.functions import text as T
from tessera.operators import taxonomy


def _brute(words, texts):
    return {(i, k): t.count(w) for i, t in enumerate(texts) for k, w in enumerate(words) if w in t}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=6).map(str.encode), unique=True, max_size=12), st.lists(st.text("abcé", max_size=40).map(str.encode), max_size=6))
def test_scan_counts_as_one_by_one(words, texts):
    offs = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    row, word, n = K.scan(K.build(words), np.frombuffer(b"".join(texts), np.uint8), offs)
    assert {(r, w): c for r, w, c in zip(row.tolist(), word.tolist(), n.tolist(), strict=True)} == _brute(words, texts)


def test_a_long_text_in_many_lanes():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcde"), 200_000))
    words = sorted({text[i : i + int(n)].encode() for i, n in zip(rng.integers(0, 199_000, 3000), rng.integers(1, 60, 3000), strict=True)})
    row, word, n = K.scan(K.build(words), np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    got = dict(zip(word.tolist(), n.tolist(), strict=True))
    assert all(got[k] == text.encode().count(w) for k, w in enumerate(words)) and set(row) == {0}


def test_folding_equals_the_native_one(spark):
    texts = ["plain ASCII", "Khí Nhà Kính ĐỘC lập", "İstanbul ΣΑΣ Σ", "ñ é", "日本 😀 ﬁ Å ḗ", "", None, "ẞß Ǆ", "한국 각"]
    want = [r[0] or "" for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.normal(F.col("t"))).collect()]
    for own in ([*texts], [t for t in texts if t and "Σ" not in t and "İ" not in t]):
        (_, _, buf, offs), = K.slices(pa.array(own, pa.string()))
        out, ends = K.normal_bytes(buf, offs)
        got = [out.tobytes()[a:b].decode() for a, b in zip(ends, ends[1:], strict=False)]
        assert got == [w for w, t in zip(want, texts, strict=True) if t in own]


def test_columns_and_dictionaries(spark):
    words = taxonomy.keywords({"E_A": {"khi": 2, "aa": 1}, "S_B": {"nha": 1, "khi": 5}})
    rows = spark.createDataFrame([(1, "Khí nhà KHI aaaa"), (2, None), (3, ""), (4, "khi" * 70_000)], "id int, t string")
    got = {r.id: r.s for r in rows.select("id", taxonomy.scored(F.col("t"), words).alias("s")).collect()}
    assert got == {1: [6, 11], 2: [0, 0], 3: [0, 0], 4: [140_000, 350_000]}
    plain = {r.id: [r.a, r.b] for r in rows.select("id", *(c.alias(n) for n, c in zip("ab", taxonomy.score(T.normal(F.col("t")), words).values(), strict=True))).na.fill(0).collect()}
    assert plain == got
    rng = np.random.default_rng(2)
    entries = [(f"c{i % 3}", "".join(rng.choice(list("abcd"), int(rng.integers(1, 7)))), int(rng.integers(1, 4))) for i in range(200)] + [("x", "", 1), (None, "a", 1), ("x", None, 1), ("c0", "É", 2)]
    texts = [(i, "".join(rng.choice(list("abcdé "), 300))) for i in range(20)]
    frame, table = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame(entries, "category string, keyword string, weight int")
    want = {}
    for i, t in texts:
        for c, k, w in entries:
            n = t.replace("é", "e").count(k.lower().replace("é", "e")) * w if c and k else 0
            if n:
                want[i, c] = want.get((i, c), 0) + n
    for cells in (K.CELLS, 300):  # in one block, and in many
        assert {(r.id, r.category): r.score for r in taxonomy.joined_scores(frame, ["id"], "t", table, cells).collect()} == want
    assert taxonomy.joined_scores(frame, ["id"], "t", table.filter("false")).count() == 0
    with pytest.raises(ValueError):
        K.build([b"a", b"a"])


def test_keywords_that_no_text_holds_take_no_blocks(spark):
    texts = spark.createDataFrame([(1, "Khí nhà kính, customer of 7"), (2, None), (3, "ab")], "id int, t string")
    there = ["khi nha", "customer", "kinh,", "ab", "7", "r of 7"]
    dictionary = spark.createDataFrame([("c", k, 1) for k in there] + [("c", f"customer#{i:09}", 1) for i in range(20_000)], "category string, keyword string, weight int")
    own = dictionary.groupBy("keyword").agg(F.collect_list(F.struct("category", "weight")).alias("own"))
    left = {r.keyword for r in taxonomy._possible(own, texts.select("t")).collect()}
    assert set(there) <= left and len(left) < len(there) + 5
    assert {(r.id, r.score) for r in taxonomy.joined_scores(texts, ["id"], "t", dictionary, 5000).collect()} == {(1, 5), (3, 1)}
