import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import taxonomy
from tessera.plans import records
from tessera.sources import errors, files, landed, sinks
from tessera.sources.settings import Settings

WORDS = taxonomy.keywords(taxonomy.ESG)


def test_names_and_paths(one, tmp_path):
    name = one(lambda x: files.safe_name(F.col(x)), x="../../etc/pass wd")
    assert "/" not in name and ".." not in name and name == "pass_wd"
    assert one(lambda x: files.safe_name(F.col(x)), x="../..") == "unnamed"
    assert files.safe_join(str(tmp_path), "reports", "a.pdf").startswith(str(tmp_path))
    with pytest.raises(ValueError):
        files.safe_join(str(tmp_path), "../../etc/passwd")


def test_binary_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7\n...")
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    (tmp_path / "c.pdf").write_bytes(b"%PDF-" + b"x" * 100)
    good, bad = files.checked(files.binary(spark, str(tmp_path), "*.pdf", max_bytes=50))
    assert [len(r.sha256) for r in good.collect()] == [64] and [r.error for r in bad.collect()] == ["not a PDF"]


def test_extractors(spark):
    docs = spark.createDataFrame([("a", b"text", "TEXT_BASED"), ("b", b"", "TEXT_BASED")], "path string, content binary, pdf_type_flag string")

    def text(content):
        if not content:
            raise errors.CorruptDocument("empty")
        return content.decode(), ["t"]

    got = {r.path: (r.raw_text, r.tables, r.error) for r in files.extracted(docs, text).collect()}
    assert got == {"a": ("text", ["t"], None), "b": (None, [], "CorruptDocument: empty")}


def test_metadata_to_json_lines(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m/1.json").write_text(json.dumps({"absolute_storage_path": "p", "ticker": "VNM", "fiscal_year": 2023, "pdf_type_flag": "SCAN_BASED"}))
    meta = landed.metadata(spark, str(tmp_path / "m")).first()
    assert (meta.heading_context, meta.normalize_ocr) == ("Thong tin chung", True)
    extracted = spark.createDataFrame([("p", "N3t Zer0 và khí nhà kính", [])], "path string, raw_text string, tables array<string>")
    out = str(tmp_path / "out")
    assert records.process(spark, str(tmp_path / "m"), extracted, WORDS, out) == 1
    (line,) = [x for f in (tmp_path / "out/ticker=VNM/fiscal_year=2023").glob("*.json") for x in f.read_text(encoding="utf-8").splitlines()]
    assert json.loads(line)["filtered_chunk_text"] == "Net Zero và khí nhà kính" and "khí" in line


def test_feeds(spark, tmp_path):
    (tmp_path / "a.rss").write_text("<rss><channel><title>c</title><item><title>t</title><link>l</link><description>d</description></item><item><title>u</title><summary>s</summary><description>d</description></item></channel></rss>")
    lost = []
    rows = landed.feeds(spark, {"A": str(tmp_path / "a.rss"), "B": str(tmp_path / "none.rss")}, lambda s, e: lost.append(s)).collect()
    assert sorted((r.source, r.title, r.published, r.body_text) for r in rows) == [("A", "t", "", "d"), ("A", "u", "", "s")] and lost == ["B"]


def test_report_fallback(spark, tmp_path):
    (tmp_path / "financials").mkdir()
    (tmp_path / "financials/V_2020.csv").write_text("ticker,year,metric,value\nV,2020,total_assets,5\n")

    def fails(ticker, year):
        raise ConnectionError

    assert landed.financial_report(spark, fails, str(tmp_path), "V", 2020).first().value == 5.0
    with pytest.raises(errors.FallbackUnavailable):
        landed.financial_report(spark, fails, str(tmp_path), "V", 2021)


def test_retry_alert_settings_and_store(spark, tmp_path):
    tries, waits = [], []

    def read():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return "ok"

    assert landed.retried(read, sleep=waits.append) == "ok" and waits == [2, 4]
    sent = []
    assert sinks.alert(15, 100, "http://x", lambda *a: sent.append(a)) and len(sent) == 1
    assert not sinks.alert(14, 100, "http://x", lambda *a: sent.append(a)) and not sinks.alert(20, 100, None) and not sinks.alert(0, 0, "http://x")
    s = Settings.load({"REDIS_PORT": "7", "S3_BUCKET": ""})
    assert s.redis_port == 7 and s.s3_bucket is None
    with pytest.raises(ValueError):
        landed.stored(spark, "mongodb://x")


def test_rejects(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r.v for r in sinks.split_rejects(rows, "v > 2", str(tmp_path / "dlq")).collect()] == [3]
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == 2


def test_json_lines_hold_all_fields_in_order(spark, tmp_path):
    odd = 'a "quoted\\" text,\x01 with   ends\n# and # marks\t'
    rows = [("VNM", 2023, i, odd if i == 2 else f" {i} ", None) for i in (3, 1, 2)]
    out = str(tmp_path / "out")
    frame = spark.createDataFrame(rows, "ticker string, fiscal_year int, pos int, text string, none string")
    assert sinks.write_records(frame, out, ("ticker", "fiscal_year", "text", "none"), ("pos",)) == 3
    (file,) = (tmp_path / "out/ticker=VNM/fiscal_year=2023").glob("*.json")
    lines = [json.loads(x) for x in file.read_text(encoding="utf-8").split("\n") if x]
    assert lines == [{"ticker": "VNM", "fiscal_year": 2023, "text": t, "none": None} for t in (" 1 ", odd, " 3 ")]


def test_oversize_files_are_rejects(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 9)
    (tmp_path / "b.bin").write_bytes(b"x" * 11)
    assert files.binary(spark, str(tmp_path), max_bytes=10).count() == 1
    (bad,) = files.oversize(spark, str(tmp_path), max_bytes=10).collect()
    assert bad.path.endswith("b.bin") and "11 bytes" in bad.error
