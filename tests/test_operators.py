import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import links as L
from tessera.functions import text as T
from tessera.operators import chunking, dedup, discovery, lifecycle, limits, metrics, quant, tables, taxonomy
from tessera.plans import records

WORDS = taxonomy.keywords(taxonomy.ESG)


def test_golden_records(spark):
    clean = "Cong ty huong toi Net Zero.\n\nTong luong phat thai CO2 nam 2023 la 1500 tan."
    (a,) = records.from_text(spark, clean, "VNM", 2023, WORDS).collect()
    assert 0 < a.token_count <= 200 and "CO2" in a.filtered_chunk_text
    (b,) = records.from_text(spark, "Cng ty huong toi N3t Zer0.\n\nTong luong phat thai CO2 nam 2023 la 1500 tan.", "VNM", 2023, WORDS, "Bao cao Moi truong", True).collect()
    assert b.filtered_chunk_text == "Cong ty huong toi Net Zero. Tong luong phat thai CO2 nam 2023 la 1500 tan."
    assert (b.heading_context, b.matched_tags, b.chunk_source) == ("Bao cao Moi truong", ["E_Emissions"], "TEXT")


def test_tables_become_records(spark):
    rows = records.from_text(spark, None, "FPT", 2022, WORDS, tables=["Chi tieu: phat thai co2", "x: y"]).collect()
    assert [(r.heading_context, r.chunk_source, r.matched_tags) for r in rows] == [("Bang du lieu", "TABLE", ["E_Emissions"])]


def test_threshold(spark):
    rows = spark.createDataFrame([("net zero, giam co2.",), ("Bao cao co minh bach.",), ("Khí nhà kính và kiểm toán độc lập",), (None,)], "t string")
    assert [r.matched_tags for r in taxonomy.tagged(rows, "t", WORDS).collect()] == [["E_Emissions"], ["E_Emissions", "G_Governance"]]


def test_taxonomy_file_and_join(spark, tmp_path):
    f = tmp_path / "t.json"
    f.write_text('{"version": "1", "categories": {"S_A": [{"keyword": "Độc lập", "weight": 2}], "E_B": [{"keyword": "co2", "weight": 1}]}}')
    words = taxonomy.load(spark, str(f))
    assert words == [("S_A", "doc lap", 2), ("E_B", "co2", 1)]
    rows = spark.createDataFrame([(1, "CO2 co2 độc lập"), (2, "")], "id int, t string")
    got = {(r.id, r.category): r.score for r in taxonomy.joined_scores(rows, ["id"], "t", taxonomy.frame(spark, words)).collect()}
    assert got == {(1, "S_A"): 2, (1, "E_B"): 2}


def test_trusted_hosts(spark):
    rows = spark.createDataFrame([("https://vinamilk.com.vn/r.pdf", "vinamilk.com.vn"), ("https://abc.vn/x.pdf", "other.com"), ("https://scribd.com/x.pdf", "v.vn"), ("https://123doc.vn/x.pdf", "v.vn"), ("user@IR.fpt.com:80/x", "FPT.com"), ("", "v.vn"), (None, "v.vn")], "u string, o string")
    assert [r[0] for r in rows.select(L.is_trusted(F.col("u"), F.col("o"))).collect()] == [True, True, False, False, True, False, False]


def test_blocklist(spark):
    rows = spark.createDataFrame([(1, "https://a.b.example.com/x"), (2, "http://EXAMPLE.com:80"), (3, "https://myexample.com"), (4, "https://[::1]:80/x"), (5, None), (6, "https://b.example.com")], "id int, u string")
    listed = spark.createDataFrame([("example.com",), ("Example.com",), ("b.example.com",), ("::1",), ("net",)], "host string")
    got = {r.id: r.blocked_by for r in discovery.blocked(rows, "u", listed).collect()}
    assert got == {1: "b.example.com", 2: "example.com", 3: None, 4: "::1", 5: None, 6: "b.example.com"}


def test_pick_report(spark):
    hits = [(1, 0, "https://scribd.com/vnm.pdf", "vinamilk.com.vn"), (1, 1, "https://news.vn/article", "vinamilk.com.vn"), (1, 2, "https://random.org/x.pdf", "vinamilk.com.vn"), (1, 3, "https://ir.vinamilk.com.vn/bctn.pdf", "vinamilk.com.vn"), (2, 0, "https://123doc.vn/a.pdf", "fpt.com.vn"), (2, 1, "https://fpt.com/r.pdf", "fpt.com.vn"), (3, 0, "https://scribd.com/a.pdf", "x.com.vn"), (4, 10, "https://a.vn/a.pdf", "x.com.vn")]
    got = dict(map(tuple, discovery.pick_report(spark.createDataFrame(hits, "q int, pos int, href string, official_domain string"), "q").collect()))
    assert got == {1: "https://ir.vinamilk.com.vn/bctn.pdf", 2: "https://fpt.com/r.pdf", 3: None}


def test_document_links(spark):
    html = '<a class="x" href="/f/download.ashx?id=3">Annual <b>report</b> 2023</a><a href="b.pdf">other</a><A HREF=\'../bctn.pdf\'> BCTN </A>'
    got = discovery.document_links(spark.createDataFrame([(1, "https://h.vn/a/b/c", html), (2, "https://h.vn", None)], "id int, url string, html string"), "id", "url", "html").collect()
    assert [(r.pos, r.href, r.label) for r in got] == [(0, "https://h.vn/f/download.ashx?id=3", "Annualreport2023"), (2, "https://h.vn/a/bctn.pdf", "BCTN")]


def test_links_of_which_one_side_matches(spark):
    pages = spark.createDataFrame([(1, "https://h.vn", '<a href="/a.pdf">other</a><a href="/b">BCTN</a><a href="/c">c</a>')], "id int, url string, html string")
    for strict, want in ((True, []), (False, ["https://h.vn/a.pdf", "https://h.vn/b"])):
        assert [r.href for r in discovery.document_links(pages, "id", "url", "html", strict=strict).collect()] == want


def test_cached_search(spark):
    asked = spark.createDataFrame([("A", 2023), ("B", 2023), ("C", 2023)], "ticker string, year int")
    cache = spark.createDataFrame([("A", 2023, "old", datetime(2024, 1, 1)), ("B", 2023, "new", datetime(2024, 3, 1))], "ticker string, year int, url string, at timestamp")
    hits = spark.createDataFrame([("A", 2023, 0, "https://a.vn/x.pdf", "a.vn")], "ticker string, year int, pos int, href string, official_domain string")
    got = {r.ticker: (r.url, r.cached) for r in discovery.cached_search(asked, cache, hits, F.expr("timestamp '2024-03-10'")).collect()}
    assert got == {"A": ("https://a.vn/x.pdf", False), "B": ("new", True), "C": (None, False)}


def test_circuit_breaker_and_defaults(spark):
    calls = spark.createDataFrame([(1, 0, False), (1, 1, True), (1, 2, False), (2, 0, False)], "run int, pos int, bad boolean")
    assert sorted((r.run, r.pos) for r in discovery.before_halt(calls, "run", "pos", F.col("bad")).collect()) == [(1, 0), (2, 0)]
    t = spark.createDataFrame([("VNM",), ("ABC",)], "ticker string")
    d = spark.createDataFrame(list(discovery.DOMAINS.items()), "ticker string, domain string")
    assert {r.ticker: r.domain for r in discovery.with_domain(t, d).collect()} == {"VNM": "vinamilk.com.vn", "ABC": "abc.com.vn"}


def test_new_items(spark):
    rows = spark.createDataFrame([(3, "A b"), (1, "c"), (2, "ab"), (4, None), (5, " ")], "id int, t string")
    assert sorted(r.id for r in dedup.new_items(rows, "t", "id").collect()) == [1, 2, 4]
    seen = dedup.hashed(rows.filter("id = 1"), "t")
    assert sorted(r.id for r in dedup.new_items(rows, "t", "id", seen).collect()) == [2, 4]


def test_statements_and_growth(spark):
    wide = spark.createDataFrame([("V", 0, "Total assets ", "10", "0", "x", "5"), ("V", 1, "total assets", "9", "9", "9", "9")], "symbol string, n int, item_en string, `2020` string, `2021` string, `2022` string, `2023` string")
    assets = quant.line_item(wide, quant.TOTAL_ASSETS, "total_assets", order="n")
    profit = assets.select("symbol", (F.col("year") + 1).alias("year"), F.lit(1.0).alias("operating_profit"))
    got = {r.year: (r.operating_profit, r.total_assets, r.asset_growth) for r in quant.yearly(profit, assets).collect()}
    assert got[2020][:2] == (None, 10.0) and math.isnan(got[2020][2])
    assert got[2021] == (1.0, 0.0, -1.0) and got[2023] == (None, 5.0, math.inf) and got[2022] == (1.0, None, None) and got[2024] == (1.0, None, None)


def test_growth_carries_nan_over(spark):
    rows = spark.createDataFrame([("V", 1, 10.0), ("V", 2, math.nan), ("V", 3, 12.0)], "symbol string, year int, v double")
    got = [r.g for r in rows.withColumn("g", quant.growth(F.col("v"))).orderBy("year").collect()]
    assert math.isnan(got[0]) and got[1] == 0.0 and got[2] == pytest.approx(0.2)
    bare = [r.g for r in rows.withColumn("g", quant.growth(F.col("v"), pad=False)).orderBy("year").collect()]
    assert all(map(math.isnan, bare))


def test_bars_and_summary(spark):
    t = datetime(2024, 1, 5)
    ticks = spark.createDataFrame([("V", t, 3.0), ("V", t + timedelta(days=1), 1.0), ("V", t + timedelta(days=40), 4.0), ("Z", t, 0.0)], "symbol string, ts timestamp, p double")
    bars = quant.monthly_bars(ticks, "symbol", "ts", "p")
    assert sorted((r.symbol, r.open, r.high, r.low, r.close) for r in bars.collect()) == [("V", 3.0, 3.0, 1.0, 1.0), ("V", 4.0, 4.0, 4.0, 4.0), ("Z", 0.0, 0.0, 0.0, 0.0)]
    share = quant.shares(spark.createDataFrame([("V", "10"), ("Z", "5")], "symbol string, issue_share string"))
    years = spark.createDataFrame([("V", 2020), ("V", 2021)], "symbol string, year int")
    got = {r.symbol: (r.last_close, r.market_cap_est, r.years_of_financials) for r in quant.summary(bars, share, years).collect()}
    assert got == {"V": (4.0, 40.0, 2), "Z": (0.0, None, 0)}


def test_moves(spark):
    pairs = [("PENDING", "DOWNLOADED"), ("EXTRACTED", "CLEANED"), ("CLEANED", "ERROR"), ("COMPLETED", "PENDING"), ("ERROR", "CHUNKED"), ("PENDING", "PENDING"), ("PENDING", "NOWHERE")]
    rows = spark.createDataFrame(pairs, "a string, b string").select(lifecycle.can_move(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in rows] == [True, True, True, False, False, False, False]


def test_lifecycle_and_upsert(spark):
    events = spark.createDataFrame([("d", 1, "DOWNLOADED"), ("d", 2, "PENDING"), ("d", 3, "ERROR"), ("e", 1, None)], "k string, seq int, s string")
    got = {r.k: (r.state, r.n, r.n_rejects) for r in lifecycle.fold(events, "k", "seq", "s").collect()}
    assert got == {"d": ("ERROR", 2, 1), "e": ("PENDING", 0, 1)}
    bad = sorted((r.k, r.src, str(r.dst)) for r in lifecycle.steps(events, "k", "seq", "s").filter("not ok").collect())
    assert bad == [("d", "DOWNLOADED", "PENDING"), ("e", "PENDING", "None")]
    log = spark.createDataFrame([("VNM_2023", 1, None, "deadbeef"), ("VNM_2023", 2, "TEXT", None), ("X", 1, None, None)], "k string, seq int, flag string, hash string")
    assert sorted(map(tuple, lifecycle.upserted(log, "k", "seq", ["flag", "hash"]).collect())) == [("VNM_2023", "TEXT", "deadbeef"), ("X", None, None)]
    table = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    changes = spark.createDataFrame([("b", None), ("c", 3)], "k string, v int")
    assert sorted(map(tuple, lifecycle.merged(table, changes, "k", ["v"]).collect())) == [("a", 1), ("b", 2), ("c", 3)]


def _calls(spark, seconds, key="k"):
    return spark.createDataFrame([(key, datetime(2024, 1, 1) + timedelta(seconds=s), i) for i, s in enumerate(seconds)], "key string, ts timestamp, id int")


def test_a_key_of_any_size_is_split(spark):
    rng = np.random.default_rng(6)
    calls = [("hot", datetime(2024, 1, 1) + timedelta(seconds=int(s)), i) for i, s in enumerate(rng.integers(0, 4000, 900))]
    calls += [("hot", None, 900), ("hot", None, 901), (None, datetime(2024, 1, 1), 902), ("b", datetime(2024, 1, 1), 903)]
    frame = spark.createDataFrame(calls, "key string, ts timestamp, id int").repartition(6)
    for seconds in (1, 60, 5000):
        plain, split = ({r.tie: r.n for r in limits.windows(frame, "key", "ts", "id", seconds, hot).collect()} for hot in (10**6, 100))
        assert plain == split and len(split) == len(calls)
    moves = spark.createDataFrame([("d", int(i), str(rng.choice([*lifecycle.STATES[: 1 + i // 90], "X"]) if i != 650 else "ERROR")) for i in rng.permutation(800)] + [("e", 1, "TAGGED")], "k string, seq int, s string")
    plain, split = (sorted(map(tuple, lifecycle.steps(moves, "k", "seq", "s", hot).collect())) for hot in (10**6, 100))
    assert plain == split and {r[4] for r in plain} == {True, False}
    lines = spark.createDataFrame([("d", int(i), f"{i}. head" if i % 50 == 7 else f"line {i}") for i in rng.permutation(600)], "k string, pos int, t string")
    plain, split = (sorted(map(tuple, chunking.heading_rows(lines, "k", "pos", "t", hot=hot).collect())) for hot in (10**6, 100))
    assert plain == split


def test_distance(spark):
    rng = np.random.default_rng(7)
    pairs = [("", ""), ("a", ""), ("", "ab"), ("kitten", "sitting"), (None, "a"), ("e\u0301", "é")]
    for n in (1, 5, 63, 64, 65, 130, 700):
        for _ in range(6):
            a = "".join(rng.choice(list("abcé日"), n))
            b = "".join(c if rng.random() < 0.8 else str(rng.choice(list("abx"))) * int(rng.integers(0, 3)) for c in a)
            pairs += [(a, b), (b, a), (a, "".join(rng.permutation(list(a))))]
    rows = spark.createDataFrame(pairs, "a string, b string")
    got = metrics.error_rates(rows, "a", "b").withColumn("want", F.levenshtein(T.nfc(F.col("a")), T.nfc(F.col("b")))).collect()
    assert len(got) == len(pairs) and all(r.edits == r.want for r in got)
    long = "ab" * 60_000
    assert T.distance(long, "x" + long[:70_000] + "yz" + long[70_003:]) == 4


def test_rate_limit(spark):
    assert [r.allowed for r in limits.rate_limited(_calls(spark, [0] * 5), "key", "ts", "id", 3, 60).orderBy("tie").collect()] == [True, True, True, False, False]
    assert [r.allowed for r in limits.rate_limited(_calls(spark, [0, 10, 20, 59, 60, 61, 130]), "key", "ts", "id", 3, 60).orderBy("tie").collect()] == [True, True, True, False, True, True, True]


def test_quota(spark):
    got = [r.exhausted for r in limits.quota(_calls(spark, range(101)), "key", "ts", "id", 100).orderBy("tie").collect()]
    assert got == [False] * 100 + [True]


def test_error_rates(spark):
    pairs = spark.createDataFrame([("abc", "abc"), ("abx", "abc"), ("", ""), ("x", ""), ("kitten", "sitting")], "a string, b string")
    assert [r.cer for r in metrics.error_rates(pairs, "a", "b").collect()] == [0.0, pytest.approx(1 / 3), 0.0, 1.0, pytest.approx(3 / 7)]
    assert metrics.corpus_error_rate(pairs.limit(2), "a", "b").first()[0] == pytest.approx(1 / 6)
    assert metrics.corpus_error_rate(pairs.filter("false"), "a", "b").first()[0] == 0.0


def test_ratios_and_levels(spark):
    row = spark.createDataFrame([(90, 100, 0, 500, 5, 0)], "a int, b int, c int, d int, e int, z int")
    assert tuple(row.select(metrics.ratio(F.col("a"), F.col("b")), metrics.ratio(F.col("c"), F.col("d")), metrics.ratio(F.col("e"), F.col("z"))).first()) == (0.9, 0.0, 0.0)
    measured = spark.createDataFrame([("ocr_cer", 0.03), ("table_extraction", 0.9), ("boundary_error", 0.02), ("taxonomy_fp", 0.08), ("throughput_pps", math.nan), ("unknown", 1.0)], "metric string, value double")
    assert {r.metric: r.passed for r in metrics.gated(measured, spark).collect()} == {"ocr_cer": True, "table_extraction": True, "boundary_error": False, "taxonomy_fp": True, "throughput_pps": False}
    assert metrics.throughput(lambda: None, 50, 20) > 0 and metrics.throughput(lambda: None, 0) == 0.0


def test_grids_and_ocr(spark):
    grid = [["Name", "CO2 "], ["a", " "], ["", None], ["b", "5", "more"], ["c"]]
    rows = spark.createDataFrame([(grid,), ([["h"]],)], "g array<array<string>>").select(tables.flatten(F.col("g")).alias("s")).collect()
    assert [r.s for r in rows] == [["Name: a", "Name: b | CO2: 5", "Name: c"], []]
    words = spark.createDataFrame([(1, 1, 0, "mot", "90"), (1, 1, 1, "x", "60.9"), (1, 1, 2, "hai", "61"), (1, 1, 3, " ", "99"), (1, 2, 0, "ba", "1e2"), (1, 2, 1, "y", "abc"), (1, 2, 2, "z", None)], "doc_id int, page int, pos int, text string, conf string")
    assert tables.ocr_text(words).first().raw_text == "mot hai\nba"


def test_new_items_keeps_one_of_ties_and_rows_without_order(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "A"), (None, "zz"), (2, "q"), (2, "q"), (None, "Q")], "n int, text string")
    got = dedup.new_items(rows, "text", "n").select("n", F.lower("text")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a"), (2, "q"), (None, "zz")], key=str)
    plan = dedup.new_items(rows, "text", "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython ") <= 2  # one for each side of the join


def test_texts_are_folded_and_chunked_once(spark):
    docs = spark.createDataFrame([("VNM", 2023, "khí nhà kính", [], None, False)], "ticker string, fiscal_year int, raw_text string, tables array<string>, heading_context string, normalize_ocr boolean")
    plan = taxonomy.tagged(docs, "raw_text", WORDS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("run(raw_text") == 1
    plan = records.build(docs, WORDS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 3  # texts are chunked, tables split, and both tagged after that


def test_links_of_any_writing(one):
    page = '<a href=/x/report.pdf>Annual report</a> <A HREF="getfile?id=1&amp;v=2"> Annual&nbsp;<b>report</b></A><a name="x">no</a><a href=\'/open.pdf\'>open <a href="/last.pdf">last'
    got = one(lambda p: L.anchors(F.col(p)), p=page)
    assert [(a.href, a.label) for a in got] == [("/x/report.pdf", "Annual report"), ("getfile?id=1&v=2", "Annualreport"), ("/open.pdf", "open"), ("/last.pdf", "last")]


def test_hosts_of_any_writing(one):
    for url, host in (("https://ir.bao.vn/a b|c.pdf", "ir.bao.vn"), ("http://bá.vn/x", "bá.vn"), ("HTTPS://user:pw@Example.NET:8080/a@b", "example.net"), ("fpt.com.vn", "fpt.com.vn"), ("/only/path", None), ("https://x.org?u=http://y.org", "x.org")):
        assert one(lambda u: L.hostname(F.col(u)), u=url) == host, url


def test_first_rows_count(spark):
    wide = spark.createDataFrame([("A", "Total Assets", "1", None), ("A", " total assets ", "5", "6"), ("B", "Other", "7", "8")], "symbol string, item_en string, `2020` string, `2021` string").coalesce(1)
    assert [tuple(r) for r in quant.line_item(wide, quant.TOTAL_ASSETS, "v").collect()] == [("A", 2020, 1.0)]
    own = spark.createDataFrame([("A", "9"), ("A", "1"), ("B", "n/a"), ("B", "2")], "symbol string, issue_share string").coalesce(1)
    assert {tuple(r) for r in quant.shares(own).collect()} == {("A", 9.0), ("B", None)}


def test_windows_of_long_keys(spark):
    import random

    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", "b", None, "c"]), datetime(2024, 1, 1) + timedelta(seconds=rnd.randint(0, 4000)), i) for i in range(3000)]
    got = {r.tie: r.n for r in limits.windows(spark.createDataFrame(rows, "k string, t timestamp, i int").repartition(7), "k", "t", "i", 60).collect()}
    want = {}
    for key in {k for k, *_ in rows}:
        start, n = None, 0
        for _, t, i in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]):
            if start is None or t - start >= timedelta(seconds=60):
                start, n = t, 0
            n += 1
            want[i] = n
    assert got == want
    assert limits.windows(spark.createDataFrame([], "k string, t timestamp, i int"), "k", "t", "i", 60).count() == 0


def test_steps_follow_the_machine(spark):
    import random

    rnd = random.Random(4)
    rows = [(rnd.randint(0, 40), i, rnd.choice([*lifecycle.STATES, "ERROR", "odd", None] if i % 9 == 0 else lifecycle.STATES)) for i in range(400)]
    want, now = {}, {}
    for k, i, dst in rows:
        src = now.get(k, "PENDING")
        ok = dst == "ERROR" or (src != "ERROR" and dst in lifecycle.STATES and lifecycle.STATES.index(dst) > lifecycle.STATES.index(src))
        want[i], now[k] = (k, src, dst, ok), dst if ok else src
    events = spark.createDataFrame(rows, "k int, i int, s string")
    assert {r.seq: (r.k, r.src, r.dst, r.ok) for r in lifecycle.steps(events, "k", "i", "s").collect()} == want
    assert {r.k: r.state for r in lifecycle.fold(events, "k", "i", "s").collect()} == now
