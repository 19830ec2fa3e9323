"""Ranks, running values and as-of joins over many blocks, against plain loops."""

import bisect

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import ordered


def _rows():
    rng = np.random.default_rng(3)
    hot = [("a", int(t), None if v % 5 == 0 else int(v)) for t, v in zip(rng.permutation(700), rng.integers(0, 60, 700), strict=True)]
    return hot + [(k, int(t), int(t * 7 % 11)) for k in (None, "b", "c") for t in rng.permutation(20)]


def test_ranked(spark):
    rows = spark.createDataFrame(_rows(), "k string, t int, v int")
    got = {(r.k, r.t): r.rank for r in ordered.ranked(rows, [F.col("t").desc(), F.col("k").asc_nulls_first()], 7).collect()}
    want = sorted(_rows(), key=lambda r: (-r[1], r[0] is not None, r[0] or ""))
    assert got == {(k, t): i + 1 for i, (k, t, _) in enumerate(want)}
    assert ordered.ranked(rows.filter("false"), [F.col("t")], 7).count() == 0


def test_running_values_split_a_hot_key(spark):
    rows = spark.createDataFrame(_rows(), "k string, t int, v int").repartition(5)
    values = {"high": ("max", F.col("v")), "low": ("min", F.col("v")), "prev": ("last", F.col("v")), "total": ("sum", F.col("v"))}
    for inclusive, hot in ((False, 100), (True, 100), (False, 10_000)):
        got = {(r.k, r.t): (r.high, r.low, r.prev, r.total) for r in ordered.running(rows, ["k"], [F.col("t")], values, 8, inclusive, hot).collect()}
        for k in ("a", "b", "c", None):
            seen = []
            for _, t, v in sorted((r for r in _rows() if r[0] == k), key=lambda r: r[1]):
                if inclusive and v is not None:
                    seen.append(v)
                assert got[k, t] == ((max(seen), min(seen), seen[-1], sum(seen)) if seen else (None,) * 4)
                if not inclusive and v is not None:
                    seen.append(v)
    sizes = ordered.blocks(rows, [F.col("k"), F.col("t")], 8).groupBy("_block").count().toPandas()["count"]
    assert len(sizes) == 8 and sizes.max() <= rows.count() / 4


def test_asof(spark):
    rng = np.random.default_rng(4)
    left = [("a" if i % 3 else None, int(t)) for i, t in enumerate(rng.integers(0, 500, 300))] + [("z", 1), ("a", None)]
    right = [("a" if i % 2 else None, int(t), f"v{t}") for i, t in enumerate(rng.permutation(500)[:90])] + [("a", None, "never")]
    args = spark.createDataFrame(left, "k string, t int"), spark.createDataFrame(right, "k string, t int, v string")
    times = {k: sorted(t for o, t, _ in right if o == k and t is not None) for k in ("a", None, "z")}
    for forward in (False, True):
        got = sorted(ordered.asof(*args, ["k"], "t", ["v"], forward, 6, 50 if forward else 10_000).collect(), key=str)
        want = []
        for k, t in left:
            at = -1 if t is None else bisect.bisect_left(times[k], t) if forward else bisect.bisect_right(times[k], t) - 1
            want.append((k, t, f"v{times[k][at]}" if 0 <= at < len(times[k]) else None))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
