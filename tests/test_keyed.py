"""The keyed table: upserts, lookups, crashes and races."""

import pytest
from pyspark.sql import functions as F

from tessera.sources import keyed


def _table(spark, tmp_path):
    return keyed.KeyedTable(spark, f"file://{tmp_path}/t", "k string, a int, b string, state string", "k", 4)


def _rows(t):
    return sorted(map(tuple, t.read().collect()))


def test_upserts(spark, tmp_path):
    t = _table(spark, tmp_path)
    assert _rows(t) == [] and t.version() == 0 and t.get("x").count() == 0
    assert t.upsert(spark.createDataFrame([("x", 1, "p"), ("y", 2, None), (None, 3, "q")], "k string, a int, b string"), {"state": "PENDING"}) == 1
    assert _rows(t) == [("x", 1, "p", "PENDING"), ("y", 2, None, "PENDING")]
    before = t.read()
    assert t.upsert(spark.createDataFrame([("x", None, "new"), ("z", 9, None)], "k string, a long, b string"), {"state": "PENDING"}) == 2
    assert _rows(t) == [("x", 1, "new", "PENDING"), ("y", 2, None, "PENDING"), ("z", 9, None, "PENDING")]
    assert t.upsert(spark.createDataFrame([("x", None, "DONE")], "k string, a int, state string"), replace=("a",)) == 3
    assert t.get("x").first() == ("x", None, "new", "DONE") and t.get("none").count() == 0
    assert sorted(r.k for r in before.collect()) == ["x", "y"]  # its version is still there
    assert t.upsert(spark.createDataFrame([], "k string, a int")) == 3
    t.vacuum()
    assert _rows(t)[0] == ("x", None, "new", "DONE") and len(list((tmp_path / "t/versions").glob("*.json"))) == 1
    again = keyed.KeyedTable(spark, t.path, "k string, a int, b string, state string", "k", 99)
    assert again.buckets == 4 and _rows(again) == _rows(t)


def test_a_lookup_reads_one_bucket(spark, tmp_path):
    t = _table(spark, tmp_path)
    t.upsert(spark.range(200).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("a")))
    assert len({f.split("_bucket=")[1][0] for f in t.read().inputFiles()}) == 4
    one = t.get("k7")
    assert len({f.split("_bucket=")[1][0] for f in one.inputFiles()}) == 1 and one.first().a == 7


def test_a_crash_and_a_race_leave_the_old_version_whole(spark, tmp_path, monkeypatch):
    t = _table(spark, tmp_path)
    rows = lambda v: spark.createDataFrame([("x", v), ("y", v)], "k string, a int")
    t.upsert(rows(1))

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(t, "_commit", dies)
        with pytest.raises(KeyboardInterrupt):
            t.upsert(rows(2))
    assert [r[1] for r in _rows(t)] == [1, 1] and t.version() == 1
    # Another writer commits between this one's look at the version and its commit.
    other, real = _table(spark, tmp_path), t._commit

    def late(*args):
        other.upsert(rows(5))
        real(*args)

    with monkeypatch.context() as m:
        m.setattr(t, "_commit", late)
        with pytest.raises(keyed.Conflict):
            t.upsert(rows(3))
    assert [r[1] for r in _rows(t)] == [5, 5] and t.version() == 2
    t.vacuum()
    assert len(list((tmp_path / "t/data").iterdir())) == 1 and [r[1] for r in _rows(t)] == [5, 5]
