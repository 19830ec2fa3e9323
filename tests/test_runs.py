import json
from datetime import datetime

from pyspark.sql import functions as F

from tessera.__main__ import main
from tessera.operators import lifecycle
from tessera.plans import runs
from tessera.sources import errors, keyed


def test_crawl(spark):
    frame = spark.createDataFrame
    asked = frame([(f"T{i}", 2024, i) for i in range(8)], "ticker string, year int, pos int")
    cache = frame([("T1", 2024, "old", datetime(2024, 1, 1)), ("T2", 2024, "kept", datetime(2024, 5, 1))], "ticker string, year int, url string, at timestamp")
    hits = frame([(f"T{i}", 2024, 0, f"https://x.vn/{i}.pdf", "x.vn") for i in (0, 1, 3, 4, 6)] + [("T5", 2024, 0, "https://scribd.com/a.pdf", "x.vn")], "ticker string, year int, pos int, href string, official_domain string")
    quota = frame([("T2", 2024), ("T6", 2024)], "ticker string, year int")  # T2 is cached, so it isn't searched
    files = frame([("https://x.vn/0.pdf", "a", None), ("https://x.vn/1.pdf", "a", None), ("kept", "b", None), ("https://x.vn/3.pdf", None, "timed out"), ("https://x.vn/4.pdf", "c", None)], "url string, content_hash string, error string")
    documents = frame([("T0_2024", None, None, None, "PENDING"), ("T2_2024", None, None, None, "COMPLETED"), ("Z_2020", None, "c", None, "TAGGED")], "doc_id string, pdf_type_flag string, content_hash string, storage_path string, state string")
    got = runs.crawl_reports(asked, cache, hits, quota, files, documents, F.lit(datetime(2024, 5, 20)))
    assert [r.outcome for r in got.outcomes.orderBy("pos").collect()] == ["saved", "skipped", "failed", "failed", "skipped", "skipped"]
    assert tuple(got.counters().first()) == (1, 3, 2)
    assert [tuple(r) for r in got.dead.collect()] == [("T6", 2024, "ddg_ratelimit")]
    after = {r.doc_id: (r.content_hash, r.state) for r in got.documents.collect()}
    assert after == {"T0_2024": ("a", "DOWNLOADED"), "T2_2024": ("b", "COMPLETED"), "Z_2020": ("c", "TAGGED")}
    assert {r.url for r in got.cache.collect()} == {f"https://x.vn/{i}.pdf" for i in (0, 1, 3, 4)}
    assert lifecycle.state_of(got.documents, "T0_2024") == "DOWNLOADED" and lifecycle.state_of(got.documents, "none") is None
    none = runs.crawl_reports(asked.filter("false"), cache, hits, quota, files, documents, F.lit(datetime(2024, 5, 20)))
    assert none.outcomes.count() == 0 and none.documents.count() == 3 and none.dead.count() == 0


def test_requests_may_repeat(spark):
    frame = spark.createDataFrame
    asked = frame([("A", 2024, 1), ("A", 2024, 1), ("B", 2024, 1), ("A", 2024, 5), ("C", 2024, 9)], "ticker string, year int, pos int")
    cache = frame([], "ticker string, year int, url string, at timestamp")
    hits = frame([(t, 2024, 0, f"https://x.vn/{t}.pdf", "x.vn") for t in "ABC"], "ticker string, year int, pos int, href string, official_domain string")
    files = frame([("https://x.vn/A.pdf", "a", None), ("https://x.vn/B.pdf", "b2", None), ("https://x.vn/B.pdf", "b1", None), ("https://x.vn/B.pdf", "b0", "late"), ("https://x.vn/C.pdf", "a", None)], "url string, content_hash string, error string")
    documents = frame([], "doc_id string, pdf_type_flag string, content_hash string, storage_path string, state string")
    got = runs.crawl_reports(asked, cache, hits, frame([], "ticker string, year int"), files, documents, F.lit(datetime(2024, 5, 20)))
    assert sorted((r.pos, r.ticker, r.outcome) for r in got.outcomes.collect()) == [(1, "A", "saved"), (1, "A", "skipped"), (1, "B", "saved"), (5, "A", "skipped"), (9, "C", "skipped")]
    assert sorted((r.doc_id, r.content_hash) for r in got.documents.collect()) == [("A_2024", "a"), ("B_2024", "b1")] and got.cache.count() == 3


def test_news_without_an_order_come_last(spark):
    feed = spark.createDataFrame([(None, "a"), (1, "A "), (None, "c")], "id int, t string")
    new, _ = runs.poll_news({"x": feed}, "t", "id")
    assert sorted(str(r.id) for r in new.collect()) == ["1", "None"]


def test_plans_compute_each_frame_once(spark):
    from tessera.plans import queries

    for name in ("crawl_reports", "crawl_documents", "scan_quantitative"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") < 30 and plan.count("FileScan") < 10, name


def test_a_crawl_into_written_tables(spark, tmp_path):
    frame, at = spark.createDataFrame, F.lit(datetime(2024, 5, 20))
    documents, cache = keyed.documents(spark, f"file://{tmp_path}/d", 3), keyed.search_cache(spark, f"file://{tmp_path}/c", 3)
    asked = frame([("A_B", 2024, 0), ("B", 2024, 1), ("C", 2024, 2), ("D", 2024, 3)], "ticker string, year int, pos int")
    hits = frame([(t, 2024, 0, f"https://x.vn/{t}.pdf", "x.vn") for t in ("A_B", "B", "D")], "ticker string, year int, pos int, href string, official_domain string")
    files = frame([("https://x.vn/A_B.pdf", "a", None), ("https://x.vn/B.pdf", None, "timed out"), ("https://x.vn/D.pdf", "d", None)], "url string, content_hash string, error string")
    told = []
    args = asked, hits, frame([("D", 2024)], "ticker string, year int"), files, documents, cache, at, f"{tmp_path}/dead"
    assert runs.crawl(*args, lambda *n: told.append(n)) == {"saved": 1, "skipped": 1, "failed": 1}
    assert [(r.doc_id, r.ticker, r.fiscal_year, r.content_hash, r.state) for r in documents.read().collect()] == [("A_B_2024", "A_B", 2024, "a", "DOWNLOADED")]
    assert sorted(r.cache_key for r in cache.read().collect()) == ["search_A_B_2024", "search_B_2024"] and told == [(1, 4)]
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/dead").collect()] == [("D", 2024, "ddg_ratelimit")]
    assert runs.crawl(*args[:2], frame([], "ticker string, year int"), *args[3:]) == {"saved": 1, "skipped": 2, "failed": 1}
    assert sorted(r.doc_id for r in documents.read().collect()) == ["A_B_2024", "D_2024"]


def test_failed_documents_are_tried_again(spark, tmp_path):
    at = F.lit(datetime(2024, 5, 20))
    documents = keyed.documents(spark, f"file://{tmp_path}/d", 3)
    documents.upsert(spark.createDataFrame([(f"{k}_2024", f"p/{k}", "PENDING" if k == "z" else "DOWNLOADED") for k in "abz"], "doc_id string, storage_path string, state string"))
    seen = tmp_path / "seen"
    seen.mkdir()

    def text(content):
        tries = len(list(seen.glob(f"{content.decode()}-*")))
        (seen / f"{content.decode()}-{tries}").touch()
        if content == b"b" or tries < 1:
            raise errors.CorruptDocument("not yet")
        return content.decode(), []

    files = spark.createDataFrame([(f"p/{k}", k.encode(), "TEXT_BASED") for k in "abzx"], "path string, content binary, pdf_type_flag string")
    good = runs.process_documents(files, documents, f"{tmp_path}/ledger", at, text)
    for _ in range(2):  # however often the results are looked at
        assert [(r.path, r.raw_text) for r in good.collect()] == [("p/a", "a")]
    assert sorted(f.name for f in seen.iterdir()) == ["a-0", "a-1", "b-0", "b-1", "b-2"]
    assert {r.doc_id: (r.state, r.error_message) for r in documents.read().collect()} == {"a_2024": ("EXTRACTED", None), "b_2024": ("ERROR", "CorruptDocument: not yet"), "z_2024": ("PENDING", None)}
    ledger = sorted((r.path, r.attempt, r.error is None) for r in spark.read.parquet(f"{tmp_path}/ledger").collect())
    assert ledger == [("p/a", 1, False), ("p/a", 2, True), ("p/b", 1, False), ("p/b", 2, False), ("p/b", 3, False)]
    assert runs.process_documents(files, documents, f"{tmp_path}/ledger", at, text).count() == 0


def test_command_line(spark, tmp_path, capsys):
    assert main(["demo"], spark) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert rows and rows[0]["ticker"] == "VNM" and rows[0]["heading_context"] == "Bao cao Moi truong"
    feed = tmp_path / "feed.xml"
    feed.write_text("<rss><channel><item><title>a</title><link>1</link><description>News  one</description></item><item><title>b</title><link>2</link><description>news one</description></item><item><title>c</title><link>3</link><description>two</description></item></channel></rss>")
    for want in ("2 new items", "0 new items"):
        assert main(["rss", f"x={feed}", "--seen", str(tmp_path / "seen")], spark) == 0
        assert capsys.readouterr().out.strip() == want
    (tmp_path / "m.json").write_text(json.dumps({"absolute_storage_path": "p", "ticker": "VNM", "fiscal_year": 2023, "pdf_type_flag": "TEXT_BASED"}))
    spark.createDataFrame([("p", "khí nhà kính", [])], "path string, raw_text string, tables array<string>").write.parquet(str(tmp_path / "x"))
    assert main(["process", str(tmp_path / "m.json"), "-o", str(tmp_path / "out"), "--extracted", str(tmp_path / "x")], spark) == 0
    assert capsys.readouterr().out.startswith("Wrote 1 records")
