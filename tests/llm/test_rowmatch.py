"""Row patterns, against a backtracking matcher."""

import hashlib
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, rowmatch
from tessera.llm.rowmatch import Letter

START, NEAR = datetime(2024, 1, 1), 300_000_000
SCHEMA = "click_id long, ts timestamp, client_id long, kind string, value double, bits int, m map<string,int>"


def _fits(letter, row, before, first):
    kind, us, c = row
    if c is None:
        return False
    if letter == "A":
        return True
    if us - before[1] > NEAR:
        return False
    if letter in "DU":
        return kind not in (None, "error") and (c < before[2] if letter == "D" else c > before[2])
    return kind == "click" and c >= first[2]


def _longest(pattern, rows, i):
    """The letters of what a backtracking matcher finds at row i, or None."""
    parts = [(c, pattern[k + 1 : k + 2] if pattern[k + 1 : k + 2] in "+*?" else "") for k, c in enumerate(pattern) if c not in "+*?"]
    todo = [(0, i, "", False)]  # the last of these is tried first
    while todo:
        k, at, word, had = todo.pop()
        if k == len(parts):
            return word
        letter, many = parts[k]
        if (had or many in ("*", "?")) and many:
            todo.append((k + 1, at, word, False))
        if at < len(rows) and not (had and many in ("", "?")) and _fits(letter, rows[at], rows[at - 1] if at > i else None, rows[i]):
            todo.append((k, at + 1, word + letter, True) if many in ("+", "*") else (k + 1, at + 1, word + letter, False))
    return None


def _brute(rows, pattern):
    keys, out = {}, []
    for click_id, ts, client, kind, value, *_ in {str(r): r for r in rows}.values():
        if client is not None and ts is not None:
            cents = None if value is None else int(np.floor(100 * value + 0.5))
            keys.setdefault(client, []).append((round((ts - START) / timedelta(microseconds=1)), click_id, kind, cents))
    for client, own in keys.items():
        own.sort(key=lambda r: r[:2])
        plain, n = [(k, us, c) for us, _, k, c in own], 0
        for i in range(len(own)):
            word = _longest(pattern, plain, i)
            if word:
                n += 1
                out.append((client, n, own[i][1], own[i + len(word) - 1][1], len(word), sum(r[3] for r in own[i : i + len(word)]), word))
    return sorted(out)


def _rows(n, seed, null=0.03, gap=0.05):
    rng = np.random.default_rng(seed)
    out, us = [], 0
    for i in range(n):
        us += 0 if rng.random() < 0.1 else NEAR if rng.random() < 0.1 else NEAR + 1 if rng.random() < gap else int(rng.integers(1, NEAR))
        value = None if rng.random() < null else float(rng.integers(-3, 12)) / 2
        client = None if rng.random() < 0.02 else int(rng.choice([7, 7, 7, 1, 2]))
        out.append((i, None if rng.random() < 0.02 else START + timedelta(microseconds=us), client, [None, "error", "view", "click", "click", "click"][rng.integers(6)], value, 5, {"a": 1}))
    return out + out[::9]


def _ours(spark, rows, pattern, **kw):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = rowmatch.match(frame, "client_id", "ts", "click_id", F.floor(100 * F.col("value") + 0.5), pattern, queries.CLICK_LETTERS, **kw)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize(("pattern", "page", "least"), [("AD+U+P", 1 << 16, 1 << 12), ("AD+U+P", 5, 8), ("A D* U? D P", 3, 50), ("AU?D*", 4, 9)])
def test_matches_equal_backtracking(spark, pattern, page, least):
    rows = _rows(400, 1) + [(i + 1000, *r[1:]) for i, r in enumerate(_rows(60, 2, 0, 0))]
    assert _ours(spark, rows, pattern, page=page, least=least) == _brute(rows, pattern.replace(" ", ""))


def test_a_run_longer_than_pages_and_blocks(spark):
    # One client falls for 60 rows and rises for 60: every row of the fall starts a match that spans many pages.
    rows = [(i, START + timedelta(seconds=i), 7, "click", float(abs(60 - i)), 1, None) for i in range(121)]
    got = _ours(spark, rows, "AD+U+P", page=4, least=20)
    assert len(got) == 60 and got == _brute(rows, "AD+U+P")


def test_nothing(spark):
    assert _ours(spark, [], "AD+U+P") == []
    rows = [(1, START, 1, "click", None, 1, None), (None, START, 1, "click", 3.0, 1, None), (None, None, None, None, None, None, None)]
    assert _ours(spark, rows, "AD+U+P") == [] and _ours(spark, rows, "A") == [(1, 1, None, None, 1, 300, "A")]
    for wrong in ("+A", "A++", "A+B", "", "A{2}"):
        with pytest.raises(ValueError):
            rowmatch.parse(wrong)


def test_query_equals_its_sql(spark):
    at = "/root/testdata/sf0.001"
    got = sorted(map(tuple, queries.op12_rowmatch(spark, at).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW clicks AS SELECT * FROM '{at}/clicks.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op12_rowmatch"]).fetchall())
    assert got == want and len(got) > 10
    assert {r[6] for r in got} >= {hashlib.sha256(b"ADUP").hexdigest()}
