from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.sources import fetched, keyed
from tessera.streaming import news, state


def test_dedup_over_runs(spark, tmp_path):
    src, at = str(tmp_path / "in"), (str(tmp_path / "out"), str(tmp_path / "state"))
    run = lambda: sorted(r.t for r in news.drained(news.new_items(news.items(spark, src, "id int, t string"), "t"), *at).collect())
    spark.createDataFrame([(1, "A"), (2, "a "), (3, "b")], "id int, t string").coalesce(1).write.parquet(src)
    first = run()
    assert len(first) == 2
    spark.createDataFrame([(4, "B"), (5, "c")], "id int, t string").coalesce(1).write.mode("append").parquet(src)
    assert len(run()) == 3


def test_limit_and_lifecycle(spark, tmp_path):
    t = datetime(2024, 1, 1)
    src = str(tmp_path / "calls")
    spark.createDataFrame([("k", t + timedelta(seconds=s), i) for i, s in enumerate([0, 10, 20, 59, 60, 61, 130])], "key string, ts timestamp, id int").coalesce(1).write.parquet(src)
    got = news.drained(state.rate_limited(news.items(spark, src, "key string, ts timestamp, id int"), "key", "ts", 3, 60), str(tmp_path / "o1"), str(tmp_path / "s1"))
    assert [r.allowed for r in got.orderBy("t").collect()] == [True, True, True, False, True, True, True]
    src = str(tmp_path / "moves")
    spark.createDataFrame([("d", 1, "DOWNLOADED"), ("d", 2, "PENDING"), ("d", 3, "ERROR"), ("d", 4, "TAGGED")], "k string, seq bigint, s string").coalesce(1).write.parquet(src)
    got = news.drained(state.lifecycle(news.items(spark, src, "k string, seq bigint, s string"), "k", "seq", "s"), str(tmp_path / "o2"), str(tmp_path / "s2"))
    assert [(r.seq, r.ok) for r in got.orderBy("seq").collect()] == [(1, True), (2, False), (3, True), (4, False)]


def _landing(spark, tmp_path, schema):
    src = str(tmp_path / "in")
    return src, lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)


def test_a_limiter_survives_a_restart_and_forgets(spark, tmp_path):
    src, land = _landing(spark, tmp_path, "key string, ts timestamp")
    t, at = datetime(2024, 1, 1), (str(tmp_path / "out"), str(tmp_path / "state"))
    run = lambda: sorted(((r.key, (r.t - t).total_seconds(), r.n) for r in news.drained(state.rate_limited(news.items(spark, src, "key string, ts timestamp"), "key", "ts", 2, 60, "1 second"), *at).collect()))
    land([("k", t), ("k", t + timedelta(seconds=30)), ("z", t + timedelta(seconds=5))])
    assert run() == [("k", 0, 1), ("k", 30, 2), ("z", 5, 1)]
    land([("k", t + timedelta(seconds=59)), ("k", t + timedelta(seconds=60))])  # a new run: the window goes on, then ends
    assert run()[2:4] == [("k", 59, 3), ("k", 60, 1)]
    land([("z", t + timedelta(seconds=600))])
    run()
    held = spark.read.format("statestore").option("stateVarName", "window").load(at[1])
    assert {r.key[0] for r in held.collect()} == {"z"}  # the watermark has passed the window of k


def test_a_cache_of_thirty_days(spark, tmp_path):
    src, land = _landing(spark, tmp_path, "key string, ts timestamp, url string")
    t, at = datetime(2024, 1, 1), (str(tmp_path / "out"), str(tmp_path / "state"))
    day = lambda n: t + timedelta(days=n)
    run = lambda: sorted((r.key, (r.t - t).days, r.url) for r in news.drained(state.cached(news.items(spark, src, "key string, ts timestamp, url string"), "key", "ts", "url"), *at).collect())
    land([("a", day(0), "u"), ("a", day(0), None), ("b", day(1), None)])
    assert run() == [("a", 0, "u"), ("b", 1, None)]
    land([("a", day(29), None), ("a", day(30), None), ("b", day(30), "v")])
    assert run() == [("a", 0, "u"), ("a", 29, "u"), ("a", 30, None), ("b", 1, None)]
    land([("b", day(50), None)])
    assert run()[-1] == ("b", 50, "v")
    held = spark.read.format("statestore").option("stateVarName", "found").load(at[1])
    assert {r.key[0] for r in held.collect()} == {"b"}


_FEED = "<rss><channel>{}</channel></rss>"
_ITEM = "<item><title>{0}</title><link>{0}</link><description>{1}</description></item>"


def test_a_stream_of_feeds_into_a_table(spark, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    spark.dataSource.register(fetched.feed_files("feeds_in_a_folder", str(folder)))
    table = keyed.KeyedTable(spark, f"file://{tmp_path}/t", "content_hash string, link string, source string", "content_hash", 2)
    stream = news.hashed(spark.readStream.format("feeds_in_a_folder").load(), "body_text").select("content_hash", "link", "source")
    run = lambda at="state": (news.into_table(stream, table, str(tmp_path / at)), sorted(r.link for r in table.read().collect()))[1]
    (folder / "2024-01-01_x.xml").write_text(_FEED.format(_ITEM.format("a", "News  one") + _ITEM.format("b", "news one") + _ITEM.format("c", "two")))
    assert run() == ["a", "c"]
    (folder / "2024-01-02_y.xml").write_text(_FEED.format(_ITEM.format("d", "TWO") + _ITEM.format("e", "three")))
    assert run() == ["a", "c", "e"] and table.version() == 2
    assert run() == ["a", "c", "e"] and run("again") == ["a", "c", "e"]  # nothing new; all batches replayed
    assert {r.link: r.source for r in table.read().collect()} == {"a": "x", "c": "x", "e": "y"} and table.version() == 2


def test_a_fetched_source(spark, tmp_path):
    tries = tmp_path / "tries"
    tries.mkdir()

    def fetch(key):
        n = len(list(tries.glob(f"{key}-*")))
        (tries / f"{key}-{n}").touch()
        if key == "b" and n < 2:
            raise ConnectionError("later")
        if key == "bad":
            raise ConnectionError("never")
        yield key, len(key)
        yield key, 7

    spark.dataSource.register(fetched.fetched("letters", "symbol string, n int", lambda: ["a", "b", "ccc", "bad"], fetch, "symbol", sleep=lambda _: None))
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = spark.read.format("letters").load()
        assert sorted(map(tuple, rows.filter("symbol in ('a', 'b') and n > 1").collect())) == [("a", 7), ("b", 7)]
        assert sorted(f.name for f in tries.iterdir()) == ["a-0", "b-0", "b-1", "b-2"]  # two retries of one, and no other key
        assert rows.filter("symbol = 'ccc'").rdd.getNumPartitions() == 1 and rows.filter("symbol = 'none'").count() == 0
        with pytest.raises(Exception, match="never"):
            rows.filter("symbol = 'bad'").collect()
        assert len(list(tries.glob("bad-*"))) >= 3
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def test_searches_and_downloads(spark):
    class RatelimitException(Exception):
        pass

    def search(query, most):
        assert query.endswith(" filetype:pdf") and most == 2
        if query.startswith("B "):
            raise RatelimitException
        if query.startswith("C "):
            raise ConnectionError
        return [f"https://x.vn/{query[0]}{i}.pdf" for i in range(5)]

    spark.dataSource.register(fetched.searches("hits", [("A", 2024, "x.vn"), ("B", 2024, "x.vn"), ("C", 2024, "x.vn")], search, 2))
    got = sorted(map(tuple, spark.read.format("hits").load().collect()), key=str)
    assert got == [("A", 2024, 0, "https://x.vn/A0.pdf", "x.vn", False), ("A", 2024, 1, "https://x.vn/A1.pdf", "x.vn", False), ("B", 2024, None, None, "x.vn", True)]

    def get(url):
        if url == "gone":
            raise ConnectionError("no route")
        yield b"<html>" if url == "page" else b"%PDF-"
        yield b"x" * (100 if url == "large" else 3)
        if url == "large":
            raise AssertionError("read on")

    spark.dataSource.register(fetched.downloads("pdfs", ["a", "gone", "page", "large", "a", "bad"], get, clean=lambda c: True, max_bytes=50, sleep=lambda _: None))
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = {r.url: (r.content and bytes(r.content), r.error) for r in spark.read.format("pdfs").load().collect()}
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)
    assert rows["a"] == (b"%PDF-xxx", None) and rows["gone"] == (None, "ConnectionError: no route") and rows["page"] == (None, "CorruptDocument: not a PDF") and rows["large"] == (None, "CorruptDocument: more than 50 bytes")


def test_saved_files(spark, tmp_path):
    from tessera.sources import files

    rows = spark.createDataFrame([("reports/A", "../2024 x.pdf", b"abc"), ("reports/A", "2024 x.pdf", b"abcd")], "folder string, name string, content binary").coalesce(1)
    assert [r.length for r in files.saved(rows, str(tmp_path)).collect()] == [3, 4]
    assert [f.name for f in (tmp_path / "reports/A").iterdir()] == ["2024_x.pdf"] and (tmp_path / "reports/A/2024_x.pdf").read_bytes() == b"abcd"
    with pytest.raises(Exception, match="outside"):
        files.saved(rows.withColumn("folder", F.lit("../..")), str(tmp_path)).collect()
