"""The registered queries: each operator over whole driver tables, and the same in DuckDB SQL.

Tables stand in for the real inputs: documents for report texts, conversations for texts of many paragraphs, pages for
portals, orders and line items for statements, events for prices, calls and lifecycle events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import links as L
from tessera.functions import text as T
from tessera.operators import chunking, dedup, discovery, lifecycle, limits, metrics, quant, tables, taxonomy
from tessera.plans import records, runs
from tessera.plans import sql
from tessera.sources import landed
from tessera.sources import keyed
from tessera.sources.shared import cut, drop_table, folder
from tessera.streaming import news, state

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Keywords that do occur in the tables.
WORDS = taxonomy.keywords({"E_Alpha": {"that": 1, "with": 2}, "E_Beta": {"this": 2}, "S_Gamma": {"pour": 1, "sich": 2}, "G_Delta": {"from": 2}, "X_Other": {"étion": 1}})


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            SQL[f.__name__] = oracle
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("source").alias("ticker"), (2020 + F.col("doc_id") % 5).cast("int").alias("fiscal_year"), F.col("text").alias("raw_text"), F.array().cast("array<string>").alias("tables"), F.lit(T.DEFAULT_HEADING).alias("heading_context"), F.lit(False).alias("normalize_ocr"))


def _flat(rows: DataFrame) -> DataFrame:
    return rows.withColumn("matched_tags", F.array_join("matched_tags", ",")).withColumn("chunk_pos", F.col("chunk_pos").cast("int"))


# --- texts -------------------------------------------------------------------------------------------------------

_CHUNK_TAIL = f"""
SELECT id AS doc_id, ticker, fiscal_year, CAST(pos - 1 AS INT) AS chunk_pos, h AS heading_context, t AS filtered_chunk_text, CAST(n AS INT) AS token_count, {sql.tags('norm', WORDS)} AS matched_tags, 'TEXT' AS chunk_source
FROM (SELECT *, {sql.normal('t')} AS norm FROM chunked) WHERE {sql.tags('norm', WORDS)} <> ''"""


@query(sql.chunks("SELECT doc_id AS id, source AS ticker, CAST(2020 + doc_id % 5 AS INT) AS fiscal_year, text AS raw FROM documents") + _CHUNK_TAIL)
def esg_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(records.build(_docs(spark, sf_dir), WORDS, keep=("doc_id",)).drop("source_ord")).select("doc_id", "ticker", "fiscal_year", "chunk_pos", "heading_context", "filtered_chunk_text", "token_count", "matched_tags", "chunk_source")


@query(sql.chunks("SELECT conv_id AS id, 'CONV' AS ticker, 2024 AS fiscal_year, string_agg(CASE WHEN turn % 7 = 3 THEN turn || '. ' || role ELSE text END, chr(10)||chr(10) ORDER BY turn) AS raw FROM conversations GROUP BY conv_id") + _CHUNK_TAIL)
def esg_chunks_multi_para(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations").withColumn("p", F.when(F.col("turn") % 7 == 3, F.concat(F.col("turn").cast("string"), F.lit(". "), "role")).otherwise(F.col("text")))
    raw = c.groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "p"))), lambda x: x.p), "\n\n").alias("raw_text"))
    docs = raw.select("doc_id", F.lit("CONV").alias("ticker"), F.lit(2024).alias("fiscal_year"), "raw_text", F.array().cast("array<string>").alias("tables"), F.lit(None).cast("string").alias("heading_context"), F.lit(False).alias("normalize_ocr"))
    return _flat(records.build(docs, WORDS, keep=("doc_id",)).drop("source_ord")).select("doc_id", "ticker", "fiscal_year", "chunk_pos", "heading_context", "filtered_chunk_text", "token_count", "matched_tags", "chunk_source")


@query(f"""SELECT doc_id, CAST(len(ps) AS INT) AS n_paragraphs, array_to_string(ps, chr(31)) AS paragraphs FROM (SELECT doc_id, {sql.paragraphs("text || chr(10) || 'Trang ' || doc_id || ' / 9' || chr(10) || chr(10) || 'end ' || doc_id")} AS ps FROM documents)""")
def clean_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    raw = F.concat("text", F.lit("\nTrang "), F.col("doc_id").cast("string"), F.lit(" / 9\n\nend "), F.col("doc_id").cast("string"))
    ps = T.paragraphs(T.nfc(raw))
    return d.select("doc_id", ps.alias("ps")).select("doc_id", F.size("ps").alias("n_paragraphs"), F.array_join("ps", "\x1f").alias("paragraphs"))


@query(
    """WITH l AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN turn || '. ' || role ELSE text END AS line FROM conversations),
h AS (SELECT *, regexp_matches(line, '^([0-9]{1,2}[.]|[0-9]{1,2}[.][0-9]{1,2}[.]?|(?i:I{1,3}|IV|V|VI{0,3}|IX|X)[.])\\s') AS is_h FROM l)
SELECT conv_id, turn, coalesce(last_value(CASE WHEN is_h THEN line END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 'Thong tin chung') AS heading, is_h AS is_heading FROM h"""
)
def heading_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    line = F.when(F.col("turn") % 3 == 0, F.concat(F.col("turn").cast("string"), F.lit(". "), "role")).otherwise(F.col("text"))
    rows = chunking.heading_rows(c.select("conv_id", "turn", line.alias("line")), "conv_id", "turn", "line")
    return rows.select("conv_id", "turn", "heading", "is_heading")


_LEET = "translate(t, '013457', 'oleast')"


@query(
    f"""WITH w AS (SELECT item_id, list_transform(string_split(replace(translate(text, 'oe', '03'), 'the', 'cng'), ' '), lambda t: CASE WHEN regexp_matches(t, '\\pL') AND regexp_matches(t, '\\p{{Nd}}') AND regexp_matches(t, '[^\\P{{L}}\\p{{Lu}}]') THEN {_LEET} ELSE t END) AS ts FROM benchmark)
SELECT item_id, array_to_string(list_transform(ts, lambda t: CASE WHEN regexp_full_match(t, '([(\\[{{"''“‘]*)([cC][nN][gG])([.,;:!?)\\]}}"''”’]*)', 's') THEN regexp_replace(t, '[cC][nN][gG]', CASE WHEN regexp_matches(t, 'C[nN][gG]') THEN 'Cong' ELSE 'cong' END) ELSE t END), ' ') AS repaired FROM w"""
)
def ocr_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "benchmark")
    return b.select("item_id", T.repair_ocr(F.replace(F.translate("text", "oe", "03"), F.lit("the"), F.lit("cng"))).alias("repaired"))


@query(f"SELECT doc_id, CAST({sql.count('text')} AS INT) AS n_tokens FROM documents")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.count_tokens(F.col("text")).alias("n_tokens"))


@query(f"SELECT doc_id, CAST(i - 1 AS INT) AS pos, s AS sentence FROM (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM (SELECT doc_id, {sql.sentences('text')} AS ss FROM documents))")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("pos", "sentence"))


@query(f"SELECT doc_id, CAST(i AS INT) AS pos, array_to_string(ws[i * 200 + 1 : i * 200 + 200], ' ') AS piece, CAST(least(200, len(ws) - i * 200) AS INT) AS n_tokens FROM (SELECT doc_id, {sql.tokens('text')} AS ws, unnest(range(0, (len({sql.tokens('text')}) + 199) // 200)) AS i FROM documents)")
def hard_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.hard_split(F.col("text"))).alias("pos", "p")).select("doc_id", "pos", F.col("p.text").alias("piece"), F.col("p.tokens").alias("n_tokens"))


@query(f"WITH src AS (SELECT doc_id AS id, 1 AS pos, {sql.strip('text')} AS p FROM documents), {sql.pieces('src')} SELECT id AS doc_id, CAST(k - 1 AS INT) AS pos, t AS piece, CAST(n AS INT) AS n_tokens FROM pieces")
def split_to_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.split_column(F.col("text"))).alias("pos", "p")).select("doc_id", "pos", F.col("p.text").alias("piece"), F.col("p.token_count").alias("n_tokens"))


@query(f"SELECT doc_id, {sql.normal('text')} AS folded FROM documents")
def diacritic_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", T.normal(F.col("text")).alias("folded"))


@query("SELECT item_id, preview, n FROM (SELECT item_id, substring(text, 1, 90) AS preview, CAST(length(text) AS INT) AS n FROM benchmark)")
def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select("item_id", records.preview(F.col("text")).alias("preview"), F.length("text").alias("n"))


_REPAIRED = f"""list_transform(string_split(replace(translate(text, 'oe', '03'), 'the', 'cng'), ' '), lambda t: CASE WHEN regexp_matches(t, '\\pL') AND regexp_matches(t, '\\p{{Nd}}') AND regexp_matches(t, '[^\\P{{L}}\\p{{Lu}}]') THEN {_LEET} ELSE t END)"""
_ITEMS = f"""SELECT item_id AS id, 'V' || item_id % 3 AS ticker, CAST(2020 + item_id % 2 AS INT) AS fiscal_year, array_to_string(list_transform({_REPAIRED}, lambda t: CASE WHEN regexp_full_match(t, '([(\\[{{"''“‘]*)([cC][nN][gG])([.,;:!?)\\]}}"''”’]*)', 's') THEN regexp_replace(t, '[cC][nN][gG]', CASE WHEN regexp_matches(t, 'C[nN][gG]') THEN 'Cong' ELSE 'cong' END) ELSE t END), ' ') AS raw FROM benchmark"""


@query(
    sql.chunks(_ITEMS)
    + f""", r AS (SELECT id, ticker, fiscal_year, 0 AS source_ord, CAST(pos - 1 AS INT) AS chunk_pos, h, t, CAST(n AS INT) AS n, 'TEXT' AS src FROM chunked UNION ALL SELECT item_id, 'V' || item_id % 3, CAST(2020 + item_id % 2 AS INT), 1, i * 100000, 'Bang du lieu', CASE i WHEN 0 THEN 'Name: with ' || item_id ELSE 'Name: plain' END, CASE i WHEN 0 THEN 3 ELSE 2 END, 'TABLE' FROM benchmark, (VALUES (0), (1)) v(i))
SELECT id AS item_id, ticker, fiscal_year, CAST(source_ord AS INT) AS source_ord, chunk_pos, h AS heading_context, t AS filtered_chunk_text, n AS token_count, {sql.tags('norm', WORDS)} AS matched_tags, src AS chunk_source FROM (SELECT *, {sql.normal('t')} AS norm FROM r) WHERE {sql.tags('norm', WORDS)} <> ''"""
)
def esg_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole records: misread texts that are repaired first, and tables beside them."""
    b, i = read(spark, sf_dir, "benchmark"), F.col("item_id")
    tables_ = F.array(F.concat(F.lit("Name: with "), i.cast("string")), F.lit("Name: plain"))
    raw = F.replace(F.translate("text", "oe", "03"), F.lit("the"), F.lit("cng"))
    docs = b.select("item_id", F.concat(F.lit("V"), (i % 3).cast("string")).alias("ticker"), (2020 + i % 2).cast("int").alias("fiscal_year"), raw.alias("raw_text"), tables_.alias("tables"), F.lit(None).cast("string").alias("heading_context"), F.lit(True).alias("normalize_ocr"))
    return _flat(records.build(docs, WORDS, keep=("item_id",)))


# --- taxonomy ----------------------------------------------------------------------------------------------------

_CATEGORIES = list(dict.fromkeys(w.category for w in WORDS))


@query(f"SELECT doc_id, {', '.join(f'CAST({sql.score("n", WORDS, c)} AS INT) AS {c.lower()}' for c in _CATEGORIES)} FROM (SELECT doc_id, {sql.normal('text')} AS n FROM documents)")
def tag_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(taxonomy.scored(F.col("text"), WORDS))).alias("s"))
    return rows.select("doc_id", *(F.col("s")[i].alias(c.lower()) for i, c in enumerate(_CATEGORIES)))


@query(f"SELECT * FROM (SELECT doc_id, {sql.tags('n', WORDS)} AS tags FROM (SELECT doc_id, {sql.normal('text')} AS n FROM documents)) WHERE tags <> ''")
def tags_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.tagged(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", WORDS).select("doc_id", F.array_join("matched_tags", ",").alias("tags"))


@query(f"SELECT tag, lang, count(*) AS n FROM (SELECT lang, unnest(string_split({sql.tags('n', WORDS)}, ',')) AS tag FROM (SELECT lang, {sql.normal('text')} AS n FROM documents)) WHERE tag <> '' GROUP BY tag, lang")
def tag_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = taxonomy.tagged(read(spark, sf_dir, "documents").select("lang", "text"), "text", WORDS)
    return rows.select("lang", F.explode("matched_tags").alias("tag")).groupBy("tag", "lang").agg(F.count("*").alias("n"))


@query(f"""SELECT doc_id, category, CAST(sum(((length(n) - length(replace(n, keyword, ''))) // length(keyword)) * weight) AS BIGINT) AS score
FROM (SELECT doc_id, {sql.normal('text')} AS n FROM documents), (VALUES {', '.join(f"('{w.category}', '{w.keyword}', {w.weight})" for w in WORDS)}) AS tax(category, keyword, weight)
WHERE contains(n, keyword) GROUP BY doc_id, category""")
def taxonomy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", "text")
    return taxonomy.joined_scores(rows, ["doc_id"], "text", taxonomy.frame(spark, WORDS)).select("doc_id", "category", F.col("score").cast("bigint").alias("score"))


_TOKEN = "regexp_split_to_array({}, '[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+')"


@query(f"""WITH d AS (SELECT doc_id, unnest({_TOKEN.format(sql.normal("text"))}) AS w FROM documents),
own AS (SELECT doc_id, w, count(*) AS n FROM d WHERE w <> '' GROUP BY doc_id, w),
words AS (SELECT DISTINCT w FROM own),
names AS (SELECT text AS x FROM benchmark UNION ALL SELECT c_name FROM customer UNION ALL SELECT p_name FROM part UNION ALL SELECT s_name FROM supplier),
dict AS (SELECT DISTINCT w AS k, 'C' || length(w) % 7 AS category, 1 + length(w) % 3 AS weight FROM (SELECT unnest({_TOKEN.format(sql.normal("x"))}) AS w FROM names) WHERE length(w) BETWEEN 3 AND 40),
parts AS (SELECT DISTINCT w, substr(w, i, n) AS k FROM (SELECT w, i, unnest(range(3, least(41, length(w) - i + 2))) AS n FROM (SELECT w, unnest(range(1, length(w) - 1)) AS i FROM words))),
hits AS (SELECT w, category, sum((length(w) - length(replace(w, k, ''))) // length(k) * weight) AS s FROM parts JOIN dict USING (k) GROUP BY w, category)
SELECT doc_id, category, CAST(sum(s * n) AS BIGINT) AS score FROM own JOIN hits USING (w) GROUP BY doc_id, category""")
def dictionary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    names = read(spark, sf_dir, "benchmark").select(F.col("text").alias("x"))
    for table, column in (("customer", "c_name"), ("part", "p_name"), ("supplier", "s_name")):
        names = names.unionByName(read(spark, sf_dir, table).select(F.col(column).alias("x")))
    n = F.length("keyword")
    words = names.select(F.explode(T.tokens(T.normal(F.col("x")))).alias("keyword")).filter(n.between(3, 40))
    dictionary = words.select(F.concat(F.lit("C"), (n % 7).cast("string")).alias("category"), "keyword", (1 + n % 3).alias("weight")).distinct()
    return taxonomy.joined_scores(d, ["doc_id"], "text", dictionary)


# --- deduplication -----------------------------------------------------------------------------------------------

_HASH = "sha256(regexp_replace(nfc_normalize(lower(text)), '[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', '', 'g'))"


@query(f"SELECT doc_id, source, h AS content_hash FROM (SELECT doc_id, source, h, row_number() OVER (PARTITION BY h ORDER BY doc_id) AS r FROM (SELECT doc_id, source, {_HASH} AS h FROM documents)) WHERE r = 1")
def news_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.new_items(read(spark, sf_dir, "documents"), "text", "doc_id").select("doc_id", "source", "content_hash")


@query(f"WITH d AS (SELECT doc_id, lang, {_HASH} AS h FROM documents), s AS (SELECT h, min(doc_id) AS found_id FROM d WHERE lang = 'en' GROUP BY h) SELECT d.doc_id, coalesce(s.found_id, -1) AS found_id FROM d LEFT JOIN s USING (h)")
def hash_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dedup.hashed(read(spark, sf_dir, "documents"), "text").select("doc_id", "lang", "content_hash")
    stored = d.filter("lang = 'en'").select("doc_id", "content_hash")
    return dedup.find_by_hash(d, stored, "content_hash", "doc_id").select("doc_id", F.coalesce("found_id", F.lit(-1)).cast("bigint").alias("found_id"))


@query(f"WITH d AS (SELECT doc_id, lang, {_HASH} AS h FROM documents) SELECT min(doc_id) AS doc_id, h AS content_hash FROM d WHERE h NOT IN (SELECT h FROM d WHERE lang = 'en') GROUP BY h")
def unseen_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    return dedup.new_items(d, "text", "doc_id", dedup.hashed(d.filter("lang = 'en'"), "text")).select("doc_id", "content_hash")


@query("SELECT CASE WHEN lang = 'en' THEN 'a' ELSE 'b' END AS feed, doc_id, CASE WHEN lang = 'en' THEN '' ELSE lang END AS published FROM documents")
def rss_feed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "lang")
    feeds = {"a": d.filter("lang = 'en'").select("doc_id"), "b": d.filter("lang <> 'en' or lang is null").select("doc_id", F.col("lang").alias("published"))}
    return landed.united(feeds).select(F.col("source").alias("feed"), "doc_id", F.when(F.col("source") == "a", "").otherwise(F.col("published")).alias("published"))


# --- discovery ---------------------------------------------------------------------------------------------------

_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1))"
_PIRACY = "(" + " OR ".join(f"{{0}} = '{h}' OR ends_with({{0}}, '.{h}')" for h in L.PIRACY_HOSTS) + ")"


_LINKS = """WITH a AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["''][^"'']*["''][^>]*>.*?</a>') AS links FROM pages),
l AS (SELECT page_id, url, unnest(links) AS a, generate_subscripts(links, 1) - 1 AS pos FROM a),
x AS (SELECT page_id, url, pos, regexp_extract(a, '(?is)href\\s*=\\s*["'']([^"'']*)["'']', 1) AS href, trim(regexp_replace(regexp_replace(a, '(?is)^<a[^>]*>|</a>$', '', 'g'), '(?s)\\s*<[^>]+>\\s*', '', 'g')) AS label FROM l)
SELECT page_id, CAST(pos AS INT) AS pos, CASE WHEN regexp_matches(href, '^[a-z]+://') THEN href ELSE regexp_extract(url, '^[a-z]+://[^/]+') || href END AS href, label FROM x"""


@query(_LINKS + " WHERE regexp_matches(href, '(?i)/[a-m]') AND regexp_matches(label, '(?i)e')")
def doc_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.document_links(read(spark, sf_dir, "pages"), "page_id", "url", "html", "(?iu)/[a-m]", "(?iu)e")


@query(_LINKS + " WHERE regexp_matches(href, '(?i)/[a-c]') OR regexp_matches(label, '(?i)x')")
def doc_links_either(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.document_links(read(spark, sf_dir, "pages"), "page_id", "url", "html", "(?iu)/[a-c]", "(?iu)x", strict=False)


@query(f"""WITH u AS (SELECT page_id, replace(url, 'example.net', CASE page_id % 4 WHEN 0 THEN 'scribd.com' WHEN 1 THEN 'bao.vn' WHEN 2 THEN '123doc.vn' ELSE 'example.net' END) AS url FROM pages)
SELECT page_id, {_HOST} AS host, {_PIRACY.format(_HOST)} AS piracy, NOT {_PIRACY.format(_HOST)} AND ({_HOST} = 'example.net' OR ends_with({_HOST}, '.example.net') OR ends_with({_HOST}, '.vn')) AS trusted FROM u""")
def trusted_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("page_id") % 4
    url = F.replace("url", F.lit("example.net"), F.when(m == 0, F.lit("scribd.com")).when(m == 1, F.lit("bao.vn")).when(m == 2, F.lit("123doc.vn")).otherwise(F.lit("example.net")))
    p = read(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    return p.select("page_id", L.hostname(F.col("url")).alias("host"), L.is_piracy(L.hostname(F.col("url"))).alias("piracy"), L.is_trusted(F.col("url"), F.lit("example.net")).alias("trusted"))


@query(f"""WITH p AS (SELECT page_id, {_HOST} AS host FROM pages), l AS (SELECT host FROM p GROUP BY host HAVING min(page_id) % 3 = 0 UNION SELECT 'example.net'),
e AS (SELECT host, list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')) AS ends FROM (SELECT DISTINCT host FROM p))
SELECT page_id, (SELECT l.host FROM l WHERE list_contains(e.ends, l.host) ORDER BY length(l.host) DESC LIMIT 1) AS blocked_by FROM p JOIN e USING (host)""")
def blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages").select("page_id", "url")
    own = p.groupBy(L.hostname(F.col("url")).alias("host")).agg(F.min("page_id").alias("first")).filter("first % 3 = 0").select("host")
    listed = own.unionByName(spark.createDataFrame([("example.net",)], "host string"))
    return discovery.blocked(p, "url", listed).select("page_id", "blocked_by")


_HITS = "SELECT page_id // 5 AS q, page_id % 5 AS pos, CASE page_id % 4 WHEN 0 THEN 'https://scribd.com/' || page_id || '.pdf' WHEN 1 THEN url WHEN 2 THEN 'https://r.org/' || page_id || '.pdf' ELSE 'https://ir.bao.vn/' || page_id || '.PDF' END AS href FROM pages"


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, m, i = read(spark, sf_dir, "pages"), F.col("page_id") % 4, F.col("page_id").cast("string")
    href = F.when(m == 0, F.concat(F.lit("https://scribd.com/"), i, F.lit(".pdf"))).when(m == 1, F.col("url")).when(m == 2, F.concat(F.lit("https://r.org/"), i, F.lit(".pdf"))).otherwise(F.concat(F.lit("https://ir.bao.vn/"), i, F.lit(".PDF")))
    return p.select(F.expr("page_id div 5").alias("q"), (F.col("page_id") % 5).alias("pos"), href.alias("href"), F.lit("bao.vn").alias("official_domain"))


_PICK = "arg_min(href, (CASE WHEN href LIKE 'https://ir.bao.vn/%' THEN 0 ELSE 100 END) + pos) FILTER (WHERE href NOT LIKE '%scribd.com/%' AND lower(href) LIKE '%.pdf%')"


@query(f"SELECT q AS query_id, {_PICK} AS url FROM ({_HITS}) GROUP BY q")
def pick_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.pick_report(_hits(spark, sf_dir), "q").select(F.col("q").alias("query_id"), "url")


@query(f"SELECT q AS query_id, {_PICK[:-1]} AND pos < 2) AS url FROM ({_HITS}) GROUP BY q")
def pick_report_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.pick_report(_hits(spark, sf_dir), "q", 2).select(F.col("q").alias("query_id"), "url")


@query(f"""WITH picked AS (SELECT q, {_PICK} AS url FROM ({_HITS}) GROUP BY q),
cache AS (SELECT q, 'cached:' || q AS url, TIMESTAMP '2024-01-01' + to_days(CAST(q % 60 AS INT)) AS found FROM picked WHERE q % 2 = 0)
SELECT 'T' || q AS ticker, CAST(2024 AS INT) AS year, coalesce(c.url, p.url) AS url, c.url IS NOT NULL AS cached FROM picked p LEFT JOIN (SELECT * FROM cache WHERE found > TIMESTAMP '2024-02-15' - INTERVAL 30 DAY) c USING (q)""")
def search_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _hits(spark, sf_dir).withColumn("ticker", F.concat(F.lit("T"), F.col("q").cast("string"))).withColumn("year", F.lit(2024))
    asked = hits.select("ticker", "year", "q").distinct()
    cache = asked.filter("q % 2 = 0").select("ticker", "year", F.concat(F.lit("cached:"), F.col("q").cast("string")).alias("url"), F.expr("timestamp '2024-01-01' + make_dt_interval(cast(q % 60 as int))").alias("at"))
    return discovery.cached_search(asked, cache, hits, F.expr("timestamp '2024-02-15'"))


@query("SELECT n_name AS ticker, coalesce(r_name || '.example.net', lower(n_name) || '.com.vn') AS domain FROM nation LEFT JOIN region ON n_nationkey = r_regionkey")
def domain_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    known = n.join(r, F.col("n_nationkey") == F.col("r_regionkey")).select(F.col("n_name").alias("ticker"), F.concat("r_name", F.lit(".example.net")).alias("domain"))
    return discovery.with_domain(n.select(F.col("n_name").alias("ticker")), known)


@query("WITH f AS (SELECT user_id, min(event_id) AS halt FROM events WHERE event_type = 'error' GROUP BY user_id) SELECT e.user_id, e.event_id FROM events e LEFT JOIN f USING (user_id) WHERE halt IS NULL OR event_id < halt")
def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return discovery.before_halt(e, "user_id", "event_id", F.col("event_type") == "error").select("user_id", "event_id")


# --- factor inputs -----------------------------------------------------------------------------------------------

_YEARS = range(1995, 2002)


def _statements(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Wide statements of each customer segment: one row an item, one column a year."""
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", F.year("o_orderdate").alias("y"), "o_totalprice", "c_acctbal")
    wide = lambda item, value: o.groupBy(F.col("c_mktsegment").alias("symbol")).pivot("y", list(_YEARS)).agg(F.round(F.sum(value), 2)).select("symbol", F.lit(item).alias("item_en"), *(f"`{y}`" for y in _YEARS))
    return wide(" operating PROFIT/(loss) ", "c_acctbal"), wide("TOTAL assets", "o_totalprice")


_LONG = "SELECT c_mktsegment AS symbol, CAST(year(o_orderdate) AS INT) AS year, round(sum(c_acctbal), 2) AS op, round(sum(o_totalprice), 2) AS ta FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"


@query(f"SELECT symbol, year, round(op, 1) AS operating_profit FROM ({_LONG}) WHERE op IS NOT NULL")
def statement_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    income, _ = _statements(spark, sf_dir)
    return quant.line_item(income, quant.OPERATING_PROFIT, "operating_profit").withColumn("operating_profit", F.round("operating_profit", 1))


@query(f"""WITH l AS ({_LONG}), a AS (SELECT DISTINCT symbol, 1996 AS year FROM l UNION ALL SELECT DISTINCT symbol, 2050 FROM l)
SELECT symbol, CAST(a.year AS INT) AS year, m AS metric, round(CASE m WHEN 'operating_profit' THEN op ELSE ta END, 0) AS value FROM a LEFT JOIN l USING (symbol, year), (VALUES ('operating_profit'), ('total_assets')) v(m)
UNION ALL SELECT 'NEW', 1999, 'total_assets', 1.5""")
def financial_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    income, balance = _statements(spark, sf_dir)
    profit, assets = quant.line_item(income, quant.OPERATING_PROFIT, "operating_profit"), quant.line_item(balance, quant.TOTAL_ASSETS, "total_assets")
    asked = income.select("symbol", F.explode(F.array(F.lit(1996), F.lit(2050))).alias("year"))
    own = quant.report(profit, assets, asked).withColumn("value", F.round("value", 0))
    backup = spark.createDataFrame([("NEW", 1999, "total_assets", 1.5), ("BUILDING", 1996, "total_assets", -1.0)], "symbol string, year int, metric string, value double")
    return quant.with_fallback(own, backup, ["symbol", "year"])


@query(f"""WITH l AS ({_LONG}), p AS (SELECT symbol, year, op FROM l WHERE year % 3 <> 0), t AS (SELECT symbol, year, ta, lag(ta) OVER (PARTITION BY symbol ORDER BY year) AS b FROM l WHERE year % 4 <> 0)
SELECT symbol, year, round(op, 0) AS operating_profit, round(ta, 0) AS total_assets, CASE WHEN t.year IS NULL THEN NULL WHEN b IS NULL THEN 'NaN' ELSE CAST(CAST(floor(1000 * (ta / b - 1)) AS BIGINT) AS VARCHAR) END AS growth_permille FROM p FULL JOIN t USING (symbol, year)""")
def ff6_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    income, balance = _statements(spark, sf_dir)
    profit = quant.line_item(income, quant.OPERATING_PROFIT, "operating_profit").filter("year % 3 <> 0")
    assets = quant.line_item(balance, quant.TOTAL_ASSETS, "total_assets").filter("year % 4 <> 0")
    g = F.col("asset_growth")
    return quant.yearly(profit, assets).select("symbol", "year", F.round("operating_profit", 0).alias("operating_profit"), F.round("total_assets", 0).alias("total_assets"), F.when(F.isnan(g), "NaN").otherwise(F.floor(1000 * g).cast("string")).alias("growth_permille"))


_BARS = "SELECT event_type AS symbol, date_trunc('month', ts) AS month, arg_min(value, (ts, value)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, value)) AS close, count(value) AS volume FROM events GROUP BY 1, 2"


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quant.monthly_bars(read(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), "ts", "value"), "symbol", "ts", "value")


@query(f"SELECT symbol, CAST(month AS TIMESTAMP) AS month, open, high, low, close, volume FROM ({_BARS})")
def monthly_ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(spark, sf_dir)


def _overview(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("click", "1000"), ("view", "n/a"), ("error", "0"), ("signup", "25.5"), ("other", "7")], "symbol string, issue_share string")


def _shares(spark: SparkSession) -> DataFrame:
    return quant.shares(_overview(spark))


_SHARES = "(VALUES ('click', 1000.0::DOUBLE), ('view', NULL), ('error', 0.0), ('signup', 25.5), ('other', 7.0)) s(symbol, shares)"


@query(f"SELECT symbol, CAST(month AS TIMESTAMP) AS month, close, shares, round(close * shares, 4) AS market_equity FROM ({_BARS}) LEFT JOIN {_SHARES} USING (symbol)")
def market_equity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quant.market_equity(_bars(spark, sf_dir), _shares(spark)).select("symbol", "month", "close", "shares", F.round("market_equity", 4).alias("market_equity"))


@query(f"""WITH b AS ({_BARS}), l AS (SELECT symbol, arg_max(close, month) AS last_close FROM b GROUP BY symbol), y AS (SELECT event_type AS symbol, count(DISTINCT user_id % 9) AS n FROM events WHERE event_type <> 'view' GROUP BY 1)
SELECT symbol, shares AS shares_outstanding, last_close, CASE WHEN last_close <> 0 AND shares <> 0 THEN round(last_close * shares, 4) END AS market_cap_est, coalesce(n, 0) AS years_of_financials FROM l FULL JOIN {_SHARES} USING (symbol) LEFT JOIN y USING (symbol)""")
def quant_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = read(spark, sf_dir, "events").filter("event_type <> 'view'").select(F.col("event_type").alias("symbol"), (F.col("user_id") % 9).alias("year"))
    return quant.summary(_bars(spark, sf_dir), _shares(spark), years).withColumn("market_cap_est", F.round("market_cap_est", 4))


@query(f"""WITH l AS ({_LONG}), b AS ({_BARS}), m AS (SELECT symbol, CAST(year(month) * 100 + month(month) AS INT) AS period, close * shares AS v FROM b LEFT JOIN {_SHARES} USING (symbol)), e AS (SELECT symbol, arg_max(close, month) AS close FROM b GROUP BY symbol)
SELECT 'yearly' AS part, symbol, year AS period, round(ta, 0) AS value FROM l UNION ALL SELECT 'monthly', symbol, period, round(v, 4) FROM m
UNION ALL SELECT 'summary', symbol, 0, CASE WHEN close <> 0 AND shares <> 0 THEN round(close * shares, 4) END FROM e FULL JOIN {_SHARES} USING (symbol)""")
def factor_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    income, balance = _statements(spark, sf_dir)
    parts = quant.factor_inputs(income, balance, _bars(spark, sf_dir), _overview(spark))
    yearly = parts["yearly"].select(F.lit("yearly").alias("part"), "symbol", F.col("year").alias("period"), F.round("total_assets", 0).alias("value"))
    monthly = parts["monthly"].select(F.lit("monthly").alias("part"), "symbol", (F.year("month") * 100 + F.month("month")).alias("period"), F.round("market_equity", 4).alias("value"))
    total = parts["summary"].select(F.lit("summary").alias("part"), "symbol", F.col("years_of_financials").cast("int").alias("period"), F.round("market_cap_est", 4).alias("value"))
    return yearly.unionByName(monthly).unionByName(total)


# --- limits and lifecycle ----------------------------------------------------------------------------------------


def _window_sql(seconds: int) -> str:
    return f"""WITH c AS (SELECT user_id, list({{'t': epoch_us(ts), 'id': event_id, 'at': 0::BIGINT, 'n': 0, 'out': []::INT[]}} ORDER BY ts, event_id) AS cs FROM events GROUP BY user_id),
f AS (SELECT user_id, cs, list_reduce(cs, lambda a, c: CASE WHEN c.t - a.at >= {seconds * 1_000_000} THEN {{'t': c.t, 'id': c.id, 'at': c.t, 'n': 1, 'out': list_append(a.out, 1)}} ELSE {{'t': c.t, 'id': c.id, 'at': a.at, 'n': a.n + 1, 'out': list_append(a.out, a.n + 1)}} END, {{'t': 0::BIGINT, 'id': 0::BIGINT, 'at': -{10**17}::BIGINT, 'n': 0, 'out': []::INT[]}}) AS r FROM c),
n AS (SELECT user_id, unnest(cs).id AS event_id, unnest(r.out) AS n FROM f)"""


@query(_window_sql(86_400) + " SELECT user_id, event_id, CAST(n AS INT) AS n, n <= 1 AS allowed FROM n")
def rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.rate_limited(read(spark, sf_dir, "events"), "user_id", "ts", "event_id", 1, 86_400).select("user_id", F.col("tie").alias("event_id"), "n", "allowed")


@query(_window_sql(86_400) + " SELECT user_id, event_id, CAST(2 - n AS INT) AS remaining, 2 - n < 0 AS exhausted FROM n")
def daily_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limits.quota(read(spark, sf_dir, "events"), "user_id", "ts", "event_id", 2).select("user_id", F.col("tie").alias("event_id"), "remaining", "exhausted")


_MOVES = "SELECT user_id, event_id, CASE WHEN event_id % 31 = 0 THEN 'ERROR' ELSE list_extract(['PENDING','DOWNLOADED','EXTRACTED','OCR_COMPLETED','CLEANED','CHUNKED','TAGGED','COMPLETED'], 1 + CAST(event_id % 8 AS INT)) END AS dst FROM events"
_ORD = "list_position(['PENDING','DOWNLOADED','EXTRACTED','OCR_COMPLETED','CLEANED','CHUNKED','TAGGED','COMPLETED'], {})"


def _moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    dst = F.when(F.col("event_id") % 31 == 0, lifecycle.ERROR).otherwise(F.element_at(F.array(*map(F.lit, lifecycle.STATES)), (1 + F.col("event_id") % 8).cast("int")))
    return read(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value", "event_type", dst.alias("dst"))


_FOLD = f"""WITH m AS ({_MOVES}), l AS (SELECT user_id, list({{'id': event_id, 'dst': dst, 's': '', 'bad': []::STRUCT(id BIGINT, src VARCHAR, dst VARCHAR)[], 'n': 0}} ORDER BY event_id) AS es FROM m GROUP BY user_id),
f AS (SELECT user_id, list_reduce(es, lambda a, e: CASE WHEN e.dst = 'ERROR' OR (a.s <> 'ERROR' AND {_ORD.format('e.dst')} > {_ORD.format('a.s')}) THEN {{'id': e.id, 'dst': e.dst, 's': e.dst, 'bad': a.bad, 'n': a.n + 1}} ELSE {{'id': e.id, 'dst': e.dst, 's': a.s, 'bad': list_append(a.bad, {{'id': e.id, 'src': a.s, 'dst': e.dst}}), 'n': a.n}} END, {{'id': 0::BIGINT, 'dst': '', 's': 'PENDING', 'bad': []::STRUCT(id BIGINT, src VARCHAR, dst VARCHAR)[], 'n': 0}}) AS r FROM l)"""


@query(_FOLD + " SELECT user_id, r.s AS state, CAST(r.n AS INT) AS n_moves, CAST(len(r.bad) AS INT) AS n_rejects FROM f")
def doc_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.fold(_moves(spark, sf_dir), "user_id", "event_id", "dst").select("user_id", "state", F.col("n").alias("n_moves"), "n_rejects")


@query(_FOLD + " SELECT user_id, b.id AS event_id, b.src AS src, b.dst AS dst FROM (SELECT user_id, unnest(r.bad) AS b FROM f)")
def state_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lifecycle.steps(_moves(spark, sf_dir), "user_id", "event_id", "dst").filter("not ok")
    return rows.select("user_id", F.col("seq").alias("event_id"), "src", "dst")


@query("""WITH e AS (SELECT 'D' || (user_id % 97) || '_' || CAST(2020 + user_id % 3 AS VARCHAR) AS doc_id, event_id, CASE WHEN event_id % 3 = 0 THEN event_type END AS pdf_type_flag, CASE WHEN event_id % 5 = 0 THEN props END AS content_hash FROM events)
SELECT doc_id, arg_max(pdf_type_flag, event_id) FILTER (WHERE pdf_type_flag IS NOT NULL) AS pdf_type_flag, arg_max(content_hash, event_id) FILTER (WHERE content_hash IS NOT NULL) AS content_hash FROM e GROUP BY doc_id""")
def doc_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    key = lifecycle.doc_key(F.concat(F.lit("D"), (F.col("user_id") % 97).cast("string")), 2020 + F.col("user_id") % 3)
    rows = e.select(key.alias("doc_id"), "event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("pdf_type_flag"), F.when(F.col("event_id") % 5 == 0, F.col("props")).alias("content_hash"))
    return lifecycle.upserted(rows, "doc_id", "event_id", ["pdf_type_flag", "content_hash"])


@query("SELECT coalesce(a.k, b.k) AS key, coalesce(b.v, a.v) AS v FROM (SELECT c_custkey AS k, c_mktsegment AS v FROM customer) a FULL JOIN (SELECT c_custkey + 100 AS k, CASE WHEN c_custkey % 5 > 0 THEN c_name END AS v FROM customer) b ON a.k = b.k")
def doc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    table = c.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("v"))
    return lifecycle.merged(table, c.select((F.col("c_custkey") + 100).alias("key"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_name")).alias("v")), "key", ["v"])


# --- keys of any size: a third of the clicks are one client's ---------------------------------------------------------

#: Clicks of a client from which on its work is split.
_HOT = 2_000


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "clicks").filter("ts is not null").groupBy("click_id").agg(F.coalesce(F.min("client_id"), F.lit(-1)).alias("client_id"), F.min("ts").alias("ts"), F.min("kind").alias("kind"), F.min("value").alias("value"))


_CLICKS = "SELECT click_id, coalesce(min(client_id), -1) AS client_id, min(ts) AS ts, min(kind) AS kind, min(value) AS value FROM clicks WHERE ts IS NOT NULL GROUP BY click_id"


def _starts_sql(key: str, seconds: int) -> str:
    """The first call of each window, each found from the one before."""
    return f"""WITH RECURSIVE c AS MATERIALIZED (SELECT click_id, {key} AS k, epoch_us(ts) AS t FROM ({_CLICKS})),
s AS (SELECT coalesce(k, -1) AS k, min(t) AS f0 FROM c GROUP BY 1 UNION SELECT s.k, (SELECT min(c.t) FROM c WHERE coalesce(c.k, -1) = s.k AND c.t >= s.f0 + {seconds * 1_000_000}) FROM s WHERE s.f0 IS NOT NULL),
w AS (SELECT c.click_id, c.k, c.t, s.f0 AS f0 FROM c ASOF JOIN (SELECT * FROM s WHERE f0 IS NOT NULL) s ON coalesce(c.k, -1) = s.k AND c.t >= s.f0),
n AS (SELECT k, click_id, row_number() OVER (PARTITION BY k, f0 ORDER BY t, click_id) AS n FROM w)"""


@query(_starts_sql("0", 86_400) + " SELECT click_id, CAST(n AS INT) AS n, n <= 50 AS allowed FROM n")
def one_key_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = _clicks(spark, sf_dir).withColumn("api", F.lit("search"))
    return limits.rate_limited(calls, "api", "ts", "click_id", 50, 86_400, hot=_HOT).select(F.col("tie").alias("click_id"), "n", "allowed")


_CLICK_MOVES = f"SELECT click_id, client_id, CASE WHEN kind = 'error' AND click_id % 1000 = 7 THEN 'ERROR' ELSE list_extract(['PENDING','DOWNLOADED','EXTRACTED','OCR_COMPLETED','CLEANED','CHUNKED','TAGGED','COMPLETED'], 1 + CAST(length(coalesce(kind, '')) AS INT) % 8) END AS dst FROM ({_CLICKS})"
_CLICK_STEPS = f"""WITH m AS ({_CLICK_MOVES}),
b AS (SELECT *, greatest(1, coalesce(max({_ORD.format('dst')}) OVER w, 1)) AS far, coalesce(bool_or(dst = 'ERROR') OVER w, false) AS failed FROM m WINDOW w AS (PARTITION BY client_id ORDER BY click_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT client_id, click_id, CASE WHEN failed THEN 'ERROR' ELSE list_extract(['PENDING','DOWNLOADED','EXTRACTED','OCR_COMPLETED','CLEANED','CHUNKED','TAGGED','COMPLETED'], far) END AS src, dst FROM b),
o AS (SELECT *, dst = 'ERROR' OR (src <> 'ERROR' AND {_ORD.format('dst')} > {_ORD.format('src')}) AS ok FROM s)"""


def _click_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = (F.col("kind") == "error") & (F.col("click_id") % 1000 == 7)
    dst = F.when(failed, lifecycle.ERROR).otherwise(F.element_at(F.array(*map(F.lit, lifecycle.STATES)), 1 + F.length(F.coalesce("kind", F.lit(""))) % 8))
    return _clicks(spark, sf_dir).select("client_id", "click_id", dst.alias("dst"))


@query(_CLICK_STEPS + " SELECT client_id, click_id, src, dst FROM o WHERE NOT ok")
def client_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lifecycle.steps(_click_moves(spark, sf_dir), "client_id", "click_id", "dst", hot=_HOT).filter("not ok")
    return rows.select("client_id", F.col("seq").alias("click_id"), "src", "dst")


@query(_CLICK_STEPS + " SELECT client_id, arg_max(CASE WHEN ok THEN dst ELSE src END, click_id) AS state, CAST(count(*) FILTER (WHERE ok) AS INT) AS n_moves, CAST(count(*) FILTER (WHERE NOT ok) AS INT) AS n_rejects FROM o GROUP BY client_id")
def client_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.fold(_click_moves(spark, sf_dir), "client_id", "click_id", "dst", hot=_HOT).select("client_id", "state", F.col("n").alias("n_moves"), "n_rejects")


@query(f"""WITH c AS ({_CLICKS}), p AS (SELECT * FROM c WHERE kind = 'purchase' AND client_id >= 0), s AS (SELECT client_id, ts, max(value) AS shares FROM c WHERE kind = 'signup' AND client_id >= 0 AND value IS NOT NULL GROUP BY 1, 2)
SELECT click_id, p.value AS close, shares, round(p.value * shares, 4) AS market_equity FROM p ASOF LEFT JOIN s ON p.client_id = s.client_id AND p.ts >= s.ts""")
def equity_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _clicks(spark, sf_dir).filter("client_id >= 0")
    bars = c.filter("kind = 'purchase'").select("click_id", F.col("client_id").alias("symbol"), F.col("ts").alias("time"), F.col("value").alias("close"))
    share_rows = c.filter("kind = 'signup' and value is not null").select(F.col("client_id").alias("symbol"), F.col("ts").alias("time"), F.col("value").alias("shares"))
    return quant.market_equity_asof(bars, share_rows, hot=_HOT).select("click_id", "close", "shares", F.round("market_equity", 4).alias("market_equity"))


# --- metrics -----------------------------------------------------------------------------------------------------


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS total, count(*) FILTER (WHERE event_type = 'error') AS failed, round(100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS error_rate, 100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*) >= 15 AS alert FROM events GROUP BY 1")
def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = read(spark, sf_dir, "events").groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("total"), F.count_if(F.col("event_type") == "error").alias("failed"))
    rate = metrics.failure_percent(F.col("failed"), F.col("total"))
    return days.select("day", "total", "failed", F.round(rate, 6).alias("error_rate"), metrics.alerts(rate).alias("alert"))


@query("SELECT count(*) FILTER (WHERE event_type = 'purchase') AS saved, count(*) FILTER (WHERE event_type = 'view') AS skipped, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) AS total FROM events")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counters(read(spark, sf_dir, "events"), "event_type", {"saved": "purchase", "skipped": "view", "failed": "error"})


@query("""WITH x AS (SELECT count(*) AS total, count(*) FILTER (WHERE quality = 1) AS correct, count(*) FILTER (WHERE toxic = 1) AS fp FROM labels)
SELECT round(correct / total, 9) AS table_accuracy, round((total - correct) / total, 9) AS boundary_error, round(fp / total, 9) AS taxonomy_fp, 0.0::DOUBLE AS empty FROM x""")
def ratio_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = read(spark, sf_dir, "labels").agg(F.count("*").alias("total"), F.count_if(F.col("quality") == 1).alias("correct"), F.count_if(F.col("toxic") == 1).alias("fp"))
    r = lambda a: F.round(metrics.ratio(a, F.col("total")), 9)
    return x.select(r(F.col("correct")).alias("table_accuracy"), r(F.col("total") - F.col("correct")).alias("boundary_error"), r(F.col("fp")).alias("taxonomy_fp"), metrics.ratio(F.col("fp"), F.lit(0)).alias("empty"))


_READ = "regexp_replace(translate(text, 'oe', '03'), 'th', '', 'g')"


@query(f"SELECT item_id, CAST(levenshtein({_READ}, text) AS INT) AS edits, round(levenshtein({_READ}, text) / length(text), 9) AS cer FROM benchmark")
def cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "benchmark").withColumn("read", F.regexp_replace(F.translate("text", "oe", "03"), "th", ""))
    return metrics.error_rates(b, "read", "text").select("item_id", F.col("edits").cast("int").alias("edits"), F.round("cer", 9).alias("cer"))


# A text in which characters are replaced by ones that it never has, and others are left out, needs an edit for each.
_NEVER = "length(text) - length(translate(replace(text, 'th', ''), 'oe', ''))"


@query(f"SELECT doc_id, CAST({_NEVER} AS BIGINT) AS edits, round(({_NEVER}) / length(text), 9) AS cer FROM documents WHERE text <> ''")
def cer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text").filter("text <> ''")
    garbled = d.withColumn("read", F.translate(F.replace("text", F.lit("th"), F.lit("")), "oe", "\x01\x02"))
    return metrics.error_rates(garbled.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id"), "read", "text").select("doc_id", "edits", F.round("cer", 9).alias("cer"))


@query(f"SELECT round(sum(levenshtein({_READ}, text)) / sum(length(text)), 9) AS corpus_cer FROM benchmark")
def corpus_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "benchmark").withColumn("read", F.regexp_replace(F.translate("text", "oe", "03"), "th", ""))
    return metrics.corpus_error_rate(b, "read", "text").select(F.round("corpus_cer", 9).alias("corpus_cer"))


@query(f"""WITH x AS (SELECT count(*) AS total, count(*) FILTER (WHERE quality = 1) AS correct, count(*) FILTER (WHERE toxic = 1) AS fp FROM labels),
m AS (SELECT 'ocr_cer' AS metric, (SELECT sum(levenshtein({_READ}, text)) / sum(length(text)) FROM benchmark) AS value, '<' AS c, 0.05 AS t UNION ALL SELECT 'table_extraction', correct / total, '>', 0.85 FROM x UNION ALL SELECT 'boundary_error', (total - correct) / total, '<', 0.01 FROM x UNION ALL SELECT 'taxonomy_fp', fp / total, '<', 0.1 FROM x UNION ALL SELECT 'throughput_pps', total, '>', 500 FROM x)
SELECT metric, round(value, 9) AS value, CASE c WHEN '<' THEN value < t ELSE value > t END AS passed FROM m""")
def sla_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = read(spark, sf_dir, "labels").agg(F.count("*").cast("double").alias("total"), F.count_if(F.col("quality") == 1).alias("correct"), F.count_if(F.col("toxic") == 1).alias("fp"))
    x = x.select(metrics.ratio(F.col("correct"), F.col("total")).alias("table_extraction"), metrics.ratio(F.col("total") - F.col("correct"), F.col("total")).alias("boundary_error"), metrics.ratio(F.col("fp"), F.col("total")).alias("taxonomy_fp"), F.col("total").alias("throughput_pps"), F.lit(1.0).alias("unknown"))
    b = read(spark, sf_dir, "benchmark").withColumn("read", F.regexp_replace(F.translate("text", "oe", "03"), "th", ""))
    measured = x.unpivot([], x.columns, "metric", "value").unionByName(metrics.corpus_error_rate(b, "read", "text").select(F.lit("ocr_cer").alias("metric"), F.col("corpus_cer").alias("value")))
    return metrics.gated(measured, spark).withColumn("value", F.round("value", 9))


# --- tables and scans --------------------------------------------------------------------------------------------

_OCR = """WITH w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM conversations),
k AS (SELECT *, CASE pos % 7 WHEN 0 THEN '60.9' WHEN 1 THEN 'x' WHEN 2 THEN '61' WHEN 3 THEN '-1' ELSE '99.5' END AS conf FROM w)"""


@query(_OCR + """, p AS (SELECT conv_id, turn, string_agg(w, ' ' ORDER BY pos) AS t FROM k WHERE conf IN ('61', '99.5') AND NOT regexp_full_match(w, '\\s*') GROUP BY conv_id, turn)
SELECT conv_id, string_agg(t, chr(10) ORDER BY turn) AS raw_text FROM p GROUP BY conv_id""")
def ocr_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("page"), F.posexplode(F.split("text", " ", -1)).alias("pos", "text"))
    m = F.col("pos") % 7
    conf = F.when(m == 0, "60.9").when(m == 1, "x").when(m == 2, "61").when(m == 3, "-1").otherwise("99.5")
    return tables.ocr_text(w.withColumn("conf", conf), "conv_id")


@query("""SELECT p_partkey, array_to_string(list_filter(['Name: ' || p_name, CASE WHEN p_size % 3 > 0 THEN 'Brand: ' || p_brand END, CASE WHEN p_size % 2 > 0 THEN 'Size: ' || p_size END], lambda x: x IS NOT NULL), ' | ') AS sentence FROM part""")
def table_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    row = F.array(F.col("p_name"), F.when(size % 3 > 0, F.col("p_brand")).otherwise(F.lit(" ")), F.when(size % 2 > 0, size.cast("string")), F.lit("beyond the header"))
    grid = F.array(F.array(F.lit(" Name"), F.lit("Brand"), F.lit("Size ")), row, F.array(F.lit("")))
    return read(spark, sf_dir, "part").select("p_partkey", F.explode(tables.flatten(grid)).alias("sentence"))


@query("""WITH r AS (SELECT s_suppkey AS doc_id, 50.0 + s_suppkey % 50 AS acc FROM supplier)
SELECT doc_id, CASE WHEN acc > 80 THEN 'a: ruled' ELSE 'a: plain' END AS sentence FROM r WHERE acc > 80 OR doc_id % 4 > 0""")
def table_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc_id"))
    grid = lambda head, cell: F.array(F.array(head, F.lit("b")), F.array(F.lit(cell), F.lit("")))
    ruled = s.select("doc_id", (50.0 + F.col("doc_id") % 50).alias("accuracy"), grid(F.lit("a"), "ruled").alias("grid"))
    plain = s.select("doc_id", F.lit(None).cast("double").alias("accuracy"), grid(F.when(F.col("doc_id") % 4 == 0, "Page 1").otherwise("a"), "plain").alias("grid"))
    return tables.pick(ruled, plain).select("doc_id", F.explode(tables.flatten(F.col("grid"))).alias("sentence"))


# --- scheduled runs --------------------------------------------------------------------------------------------------

_CRAWL = f"""WITH picked AS (SELECT q, {_PICK} AS found FROM ({_HITS}) GROUP BY q),
cache AS (SELECT q, 'cached:' || q AS hit FROM picked WHERE q % 4 = 1 AND q % 60 > 14),
a AS (SELECT q, q AS pos, 1 AS nth FROM picked UNION ALL SELECT q, (SELECT max(q) FROM picked), 2 FROM picked WHERE q % 5 = 0),
r AS (SELECT 'T' || p.q AS ticker, p.q AS q, a.pos, a.nth, coalesce(hit, found) AS url, hit IS NULL AND p.q % 2 = 0 AND p.q >= (SELECT max(q) FROM picked) - 6 AS halts FROM a JOIN picked p USING (q) LEFT JOIN cache ON cache.q = p.q),
n AS (SELECT *, row_number() OVER (ORDER BY pos, ticker, nth) AS i FROM r),
t AS (SELECT *, CASE WHEN q % 11 <> 5 THEN 'h' || CASE WHEN q % 3 = 0 THEN q // 2 * 2 ELSE q END END AS hash FROM n WHERE i < coalesce((SELECT min(i) FROM n WHERE halts), 1000000000)),
d AS (SELECT 'T' || q || '_2024' AS doc_id, CASE WHEN q % 14 = 0 THEN 'h' || (q + 1) END AS content_hash, CASE WHEN q % 21 = 0 THEN 'COMPLETED' ELSE 'PENDING' END AS state FROM picked WHERE q % 7 = 0),
o AS (SELECT ticker, pos, url, hash, CASE WHEN url IS NULL THEN 'skipped' WHEN hash IS NULL THEN 'failed' WHEN hash IN (SELECT content_hash FROM d WHERE content_hash IS NOT NULL) OR i > min(CASE WHEN url IS NOT NULL THEN i END) OVER (PARTITION BY hash) THEN 'skipped' WHEN state = 'COMPLETED' THEN 'failed' ELSE 'saved' END AS outcome, state FROM t LEFT JOIN d ON d.doc_id = ticker || '_2024')"""


def _crawl(spark: SparkSession, sf_dir: str) -> runs.Crawl:
    hits = _hits(spark, sf_dir).withColumn("ticker", F.concat(F.lit("T"), F.col("q").cast("string"))).withColumn("year", F.lit(2024))
    asked = hits.groupBy("ticker", "year").agg(F.min("q").alias("q"))
    text = lambda c: F.col(c).cast("string")
    last = asked.agg(F.max("q").alias("last"))
    cache = asked.filter("q % 4 = 1").select("ticker", "year", F.concat(F.lit("cached:"), text("q")).alias("url"), F.expr("timestamp '2024-01-01' + make_dt_interval(cast(q % 60 as int))").alias("at"))
    quota = asked.join(F.broadcast(last), F.lit(True)).filter("q % 2 = 0 and q >= last - 6").select("ticker", "year")
    urls = discovery.cached_search(asked, cache, hits, F.expr("timestamp '2024-02-15'")).join(asked, ["ticker", "year"]).filter("url is not null")
    h = F.concat(F.lit("h"), F.when(F.col("q") % 3 == 0, F.expr("q div 2 * 2")).otherwise(F.col("q")).cast("string"))
    files = urls.select("url", h.alias("content_hash"), F.when(F.col("q") % 11 == 5, "timed out").alias("error"))
    documents = asked.filter("q % 7 = 0").select(lifecycle.doc_key(F.col("ticker"), F.col("year")).alias("doc_id"), F.lit(None).cast("string").alias("pdf_type_flag"), F.when(F.col("q") % 14 == 0, F.concat(F.lit("h"), (F.col("q") + 1).cast("string"))).alias("content_hash"), F.lit(None).cast("string").alias("storage_path"), F.when(F.col("q") % 21 == 0, "COMPLETED").otherwise("PENDING").alias("state"))
    # Every fifth is asked twice, the second time together with the last of all.
    twice = asked.join(F.broadcast(last), F.lit(True)).filter("q % 5 = 0").select("ticker", "year", F.col("last").alias("q"))
    return runs.crawl_reports(asked.unionByName(twice).withColumnRenamed("q", "pos"), cache, hits, quota, files, documents, F.expr("timestamp '2024-02-15'"))


@query(_CRAWL + " SELECT ticker, pos, url, outcome FROM o")
def crawl_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crawl(spark, sf_dir).outcomes.select("ticker", "pos", "url", "outcome")


@query(_CRAWL + """, s AS (SELECT *, outcome = 'saved' OR (outcome = 'failed' AND hash IS NOT NULL) AS stored FROM o)
SELECT coalesce(d.doc_id, s.ticker || '_2024') AS doc_id, CASE WHEN stored THEN 'TEXT_BASED' END AS pdf_type_flag, CASE WHEN stored THEN s.hash ELSE d.content_hash END AS content_hash, CASE WHEN stored THEN 'reports/' || s.ticker || '/2024.pdf' END AS storage_path, CASE WHEN outcome = 'saved' THEN 'DOWNLOADED' ELSE d.state END AS state FROM d FULL JOIN (SELECT * FROM s WHERE stored) s ON d.doc_id = s.ticker || '_2024'""")
def crawl_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crawl(spark, sf_dir).documents


@query(f"""WITH l AS ({_LONG}), t AS (SELECT DISTINCT symbol FROM l UNION ALL SELECT 'NEW' UNION ALL SELECT 'NONE')
SELECT symbol, 1996 AS year, m AS metric, round(CASE m WHEN 'operating_profit' THEN op ELSE ta END, 0) AS value FROM (SELECT DISTINCT symbol FROM l) LEFT JOIN (SELECT * FROM l WHERE year = 1996) USING (symbol), (VALUES ('operating_profit'), ('total_assets')) v(m)
UNION ALL SELECT 'NEW', 1996, 'total_assets', 2.0 UNION ALL SELECT 'counted', CAST(count(*) AS INT), 'failed', 1.0 FROM t""")
def scan_quantitative(spark: SparkSession, sf_dir: str) -> DataFrame:
    income, balance = _statements(spark, sf_dir)
    profit, assets = quant.line_item(income, quant.OPERATING_PROFIT, "operating_profit"), quant.line_item(balance, quant.TOTAL_ASSETS, "total_assets")
    tickers = income.select("symbol").unionByName(spark.createDataFrame([("NEW",), ("NONE",)], "symbol string"))
    fallback = spark.createDataFrame([("NEW", 1996, "total_assets", 2.0), ("NEW", 1997, "total_assets", 3.0), ("BUILDING", 1996, "total_assets", -1.0), ("GONE", 1996, "total_assets", 5.0)], "symbol string, year int, metric string, value double")
    rows, n = runs.scan_quantitative(tickers, profit, assets, fallback, 1996)
    counted = n.select(F.lit("counted").alias("symbol"), F.col("total").cast("int").alias("year"), F.lit("failed").alias("metric"), F.col("failed").cast("double").alias("value"))
    return rows.withColumn("value", F.round("value", 0)).unionByName(counted)


@query(f"WITH d AS (SELECT doc_id, lang, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS feed, CASE WHEN doc_id % 3 > 0 THEN doc_id END AS link, {_HASH} AS h FROM documents) SELECT CASE feed WHEN 0 THEN 'rest' ELSE 'en' END AS source, coalesce(link, -1) AS link, h AS content_hash FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY feed, link NULLS LAST) AS r FROM d WHERE h NOT IN (SELECT h FROM d WHERE lang = 'de')) WHERE r = 1")
def poll_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    d = d.withColumn("link", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    feeds = {"rest": d.filter("lang is distinct from 'en'"), "en": d.filter("lang = 'en'")}
    new, _ = runs.poll_news(feeds, "text", "link", dedup.hashed(d.filter("lang = 'de'"), "text"))
    return new.select("source", F.coalesce("link", F.lit(-1)).alias("link"), "content_hash")


# --- streams, drained ------------------------------------------------------------------------------------------------


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """What the stream makes of all that has landed; its folders are removed once that is kept."""
    at = folder(spark, "stream")
    out = cut(news.drained(stream, f"{at}/out", f"{at}/state"))
    drop_table(spark, at)
    return out


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path if _is_dir(spark, path) else f"{sf_dir}/{name}*.parquet")


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@query(f"SELECT DISTINCT {_HASH} AS content_hash FROM documents")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(spark, news.new_items(_stream(spark, sf_dir, "documents").select("text"), "text").select("content_hash"))


@query(_window_sql(86_400) + " SELECT user_id, CAST(n AS INT) AS n, n <= 1 AS allowed FROM n")
def stream_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drained(spark, state.rate_limited(_stream(spark, sf_dir, "events"), "user_id", "ts", 1, 86_400)).select(F.col("key").alias("user_id"), "n", "allowed")


@query(_FOLD + " SELECT user_id, b.id AS event_id, b.src AS src, b.dst AS dst FROM (SELECT user_id, unnest(r.bad) AS b FROM f)")
def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _stream(spark, sf_dir, "events")
    dst = F.when(F.col("event_id") % 31 == 0, lifecycle.ERROR).otherwise(F.element_at(F.array(*map(F.lit, lifecycle.STATES)), (1 + F.col("event_id") % 8).cast("int")))
    rows = _drained(spark, state.lifecycle(e.select("user_id", "event_id", dst.alias("dst")), "user_id", "event_id", "dst"))
    return rows.filter("not ok").select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), "src", "dst")


# --- written tables ----------------------------------------------------------------------------------------------------


@query("""WITH u AS (SELECT doc_id, source, lang, length(text) AS n FROM documents), a AS (SELECT 'D' || doc_id AS k, source, CASE WHEN n % 3 > 0 THEN lang END AS lang FROM u WHERE doc_id % 2 = 0),
b AS (SELECT 'D' || doc_id AS k, CASE WHEN n % 5 > 0 THEN source || '/' || lang END AS path, CASE WHEN n % 7 > 0 THEN 'en' END AS lang FROM u WHERE doc_id % 3 = 0)
SELECT coalesce(a.k, b.k) AS doc_id, coalesce(a.source, '-') AS ticker, coalesce(b.path, '-') AS storage_path, coalesce(b.lang, a.lang, '-') AS pdf_type_flag, 'PENDING' AS state FROM a FULL JOIN b ON a.k = b.k""")
def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("key"), "doc_id", "source", "lang", F.length("text").alias("n"))
    at = folder(spark, "documents")
    table = keyed.documents(spark, at)
    table.upsert(d.filter("doc_id % 2 = 0").select(F.col("key").alias("doc_id"), F.col("source").alias("ticker"), F.when(F.col("n") % 3 > 0, F.col("lang")).alias("pdf_type_flag")), {"state": lifecycle.STATES[0]})
    table.upsert(d.filter("doc_id % 3 = 0").select(F.col("key").alias("doc_id"), F.when(F.col("n") % 5 > 0, F.concat("source", F.lit("/"), "lang")).alias("storage_path"), F.when(F.col("n") % 7 > 0, "en").alias("pdf_type_flag")), {"state": lifecycle.STATES[0]})
    named = lambda c: F.coalesce(c, F.lit("-")).alias(c)
    out = cut(table.read().select("doc_id", named("ticker"), named("storage_path"), named("pdf_type_flag"), "state"))
    drop_table(spark, at)
    return out


@query(f"SELECT h AS content_hash, arg_min(doc_id, (doc_id % 2, doc_id)) AS doc_id FROM (SELECT doc_id, {_HASH} AS h FROM documents) GROUP BY h")
def feed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News that land in two steps, streamed into a table; the second run takes up the stream where the first ended."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    at = folder(spark, "feed")
    table = keyed.KeyedTable(spark, f"{at}/table", "content_hash string, doc_id bigint", "content_hash")
    for step in (0, 1):
        d.filter(F.col("doc_id") % 2 == step).write.mode("append").parquet(f"{at}/landed")
        stream = dedup.hashed(news.items(spark, f"{at}/landed", "doc_id bigint, text string"), "text")
        news.into_table(stream.select("content_hash", "doc_id"), table, f"{at}/state")
    out = cut(table.read())
    drop_table(spark, at)
    return out


@query("SELECT CAST(i AS INT) AS attempt, doc_id, CASE WHEN doc_id % 7 < i THEN 'done' ELSE 'failed' END AS outcome FROM documents, (VALUES (1), (2), (3)) v(i) WHERE i = 1 OR doc_id % 7 >= i - 1")
def attempts_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id")
    work = lambda rows, n: rows.withColumn("error", F.when(F.col("doc_id") % 7 >= n, "busy"))
    _, ledger = runs.attempts(d, "doc_id", work)
    return ledger.select("attempt", "doc_id", F.when(F.col("error").isNull(), "done").otherwise("failed").alias("outcome"))
