"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, chunkdedup, decontaminate, hilbert, importance, linededup, minhash, packing, pii, quality, rowmatch, tokenfile, toxicity

#: The label table annotates two categories; the chain predicts them in this order.
CATEGORIES = {"degraded": "quality = 0", "toxic": "toxic = 1"}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def line_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links between the line sets of op1, and their classes, whether or not a line was removed for another reason."""
    return linededup.line_links(_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.neighbours(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, num=80, den=100)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenfile.new_path(spark)
    tokenfile.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, recognise=True)
    return tokenfile.summary(spark, path)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), CATEGORIES, "toxic")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunkdedup.dedup_substrings(_table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = importance.weights(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=2, buckets=10_000)
    return importance.resample(weighed, percent=25, least_words=20, seed=7)


_NEAR_US = 5 * 60 * 1_000_000
_KNOWN = "kind <> 'error'"
#: A any row, D and U below and above the row before, P a click worth the first row at least; the last three within five minutes of the row before.
CLICK_LETTERS = {"A": rowmatch.Letter(), "D": rowmatch.Letter(_KNOWN, -1, _NEAR_US), "U": rowmatch.Letter(_KNOWN, 1, _NEAR_US), "P": rowmatch.Letter("kind = 'click'", 0, _NEAR_US, True)}


def op12_rowmatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.floor(100 * F.nanvl("value", F.lit(None)) + 0.5)
    out = rowmatch.match(_table(spark, sf_dir, "clicks"), "client_id", "ts", "click_id", cents, "A D+ U+ P", CLICK_LETTERS)
    return out.select("client_id", "match_no", "first_id", "last_id", "n_rows", F.col("total").alias("sum_cents"), F.sha2("labels", 256).alias("labels_sha256"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0, recognise=True)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_decontaminate, op3_hilbert, op4_minhash, op5_bpe, op6_token_files, op7_toxicity, op8_pii, op9_quality, op10_substring_dedup, op11_importance, op12_rowmatch, op13_packing, line_links)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = "list_filter(regexp_split_to_array(" + _LOWER + ", '{}'), lambda x: x <> '')"


def _solid(x: str) -> str:
    return _SPLIT.format(x, r"[\x20\x09-\x0D]+")


def _alnum(x: str) -> str:
    return _SPLIT.format(x, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


_LINE_PAIRS = f"""WITH RECURSIVE l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
lines AS (SELECT * FROM (SELECT doc_id, line, list_sort(list_distinct({_solid("s")})) AS ws FROM l) WHERE len(ws) > 0),
sets AS (SELECT ws, len(ws) AS n, min({{'d': doc_id, 'l': line}}) AS place, row_number() OVER () AS sid FROM lines GROUP BY ws),
words AS (SELECT sid, n, unnest(ws) AS w FROM sets),
freq AS (SELECT w, count(*) AS f FROM words GROUP BY w),
prefix AS (SELECT sid, n, w FROM (SELECT sid, n, w, row_number() OVER (PARTITION BY sid ORDER BY f, w) AS p FROM words JOIN freq USING (w)) WHERE p <= n - (80 * n + 99) // 100 + 1),
pairs AS (SELECT DISTINCT a.sid AS x, b.sid AS y FROM prefix a JOIN prefix b USING (w) WHERE a.sid <> b.sid AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),"""

_LINES = _LINE_PAIRS + f"""
links AS (SELECT DISTINCT x AS sid FROM pairs JOIN sets a ON x = a.sid JOIN sets b ON y = b.sid WHERE b.place < a.place AND 180 * len(list_intersect(a.ws, b.ws)) >= 80 * (a.n + b.n)),
gone AS (SELECT doc_id, line, place.d AS first_doc, links.sid IS NOT NULL AS near FROM lines JOIN sets USING (ws) LEFT JOIN links USING (sid) WHERE links.sid IS NOT NULL OR place <> {{'d': doc_id, 'l': line}}),
kept AS (SELECT l.doc_id, string_agg(s, chr(10) ORDER BY l.line) FILTER (WHERE g.doc_id IS NULL) AS text, count(*) AS n_lines, count(g.doc_id) AS n_removed, string_agg(l.line, ',' ORDER BY l.line) FILTER (WHERE g.doc_id IS NOT NULL) AS removed, count(*) FILTER (WHERE near) AS n_links, min(first_doc) AS class_id FROM l LEFT JOIN gone g USING (doc_id, line) GROUP BY l.doc_id)
SELECT doc_id, coalesce(text, '') AS text, n_lines, n_removed, coalesce(removed, '') AS removed, n_links, coalesce(class_id, doc_id) AS class_id FROM kept"""

_LINE_LINKS = _LINE_PAIRS + """
links AS (SELECT x, y FROM pairs JOIN sets a ON x = a.sid JOIN sets b ON y = b.sid WHERE 180 * len(list_intersect(a.ws, b.ws)) >= 80 * (a.n + b.n)),
n AS (SELECT x AS sid, count(*) AS n_links FROM links GROUP BY x),
reach AS (SELECT sid, sid AS r FROM sets UNION SELECT reach.sid, links.y FROM reach JOIN links ON reach.r = links.x),
class AS (SELECT reach.sid, min(place) AS first FROM reach JOIN sets ON reach.r = sets.sid GROUP BY reach.sid)
SELECT doc_id, CAST(line AS INT) AS line, coalesce(n_links, 0) AS n_links, first.d AS class_doc, CAST(first.l AS INT) AS class_line FROM lines JOIN sets USING (ws) JOIN class USING (sid) LEFT JOIN n USING (sid)"""

_LEAKS = f"""WITH d AS (SELECT doc_id, {_alnum("coalesce(text, '')")} AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_alnum("coalesce(text, '')")} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[j : j + n - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS j FROM i)),
grams AS (SELECT doc_id, n, j, array_to_string(w[j : j + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS j FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, j, n, item_id FROM grams JOIN windows USING (n, k)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + n)) AS p FROM found) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN own USING (doc_id)"""

_NEAR = f"""WITH RECURSIVE d AS (SELECT doc_id, {_solid("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda j: hash(array_to_string(w[j : j + 3], ' '))) WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END) AS g FROM d),
e AS (SELECT doc_id, unnest(g) AS k FROM s),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM e a JOIN e b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN s a ON x = a.doc_id JOIN s b ON y = b.doc_id WHERE 100 * n >= 80 * (len(a.g) + len(b.g) - n)),
reach AS (SELECT doc_id, doc_id AS r FROM s UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x)
SELECT doc_id, CAST(len(any_value(g)) AS BIGINT) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM s JOIN reach USING (doc_id) GROUP BY doc_id"""

_MATCHES = """WITH d AS (SELECT DISTINCT * FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
r AS (SELECT client_id AS k, click_id, ts, kind, CAST(floor(100 * value + 0.5) AS BIGINT) AS c, row_number() OVER (PARTITION BY client_id ORDER BY ts, click_id) AS n FROM d),
b AS (SELECT *, lag(c) OVER w AS pc, lag(ts) OVER w AS pt, sum(c) OVER w AS upto FROM r WINDOW w AS (PARTITION BY k ORDER BY n)),
f AS (SELECT *, coalesce(c < pc AND kind <> 'error' AND ts <= pt + INTERVAL 5 MINUTE, false) AS d, coalesce(c > pc AND kind <> 'error' AND ts <= pt + INTERVAL 5 MINUTE, false) AS u, coalesce(c + pc IS NOT NULL AND kind = 'click' AND ts <= pt + INTERVAL 5 MINUTE, false) AS p FROM b),
e AS (SELECT *, coalesce(min(CASE WHEN NOT d THEN n END) OVER later, count(*) OVER (PARTITION BY k) + 1) - 1 AS low, coalesce(min(CASE WHEN NOT u THEN n END) OVER later, count(*) OVER (PARTITION BY k) + 1) - 1 AS high FROM f WINDOW later AS (PARTITION BY k ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
s AS (SELECT a.k, a.n, a.c, a.click_id, a.upto, a.low, v.high FROM e a JOIN e v ON v.k = a.k AND v.n = a.low WHERE a.low > a.n AND v.high > a.low),
m AS (SELECT s.k, s.n, max(z.n) AS z FROM s JOIN e z ON z.k = s.k AND z.n BETWEEN s.low + 2 AND s.high + 1 AND z.p AND z.c >= s.c GROUP BY s.k, s.n)
SELECT s.k AS client_id, row_number() OVER (PARTITION BY s.k ORDER BY s.n) AS match_no, s.click_id AS first_id, z.click_id AS last_id, m.z - s.n + 1 AS n_rows, CAST(z.upto - s.upto + s.c AS BIGINT) AS sum_cents, sha256('A' || repeat('D', CAST(s.low - s.n AS INT)) || repeat('U', CAST(m.z - 1 - s.low AS INT)) || 'P') AS labels_sha256
FROM m JOIN s ON s.k = m.k AND s.n = m.n JOIN e z ON z.k = m.k AND z.n = m.z"""

_GUMBEL = f"""WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, row_number() OVER () AS r, {_alnum("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT {_alnum("coalesce(text, '')")} AS w FROM benchmark),
own AS (SELECT r, f, count(*) AS n FROM (SELECT r, unnest(w) AS f FROM d UNION ALL SELECT r, unnest(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) FROM d) GROUP BY r, f),
theirs AS (SELECT f, count(*) AS n FROM (SELECT unnest(w) AS f FROM b UNION ALL SELECT unnest(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) FROM b) GROUP BY f),
h AS (SELECT f, hex(f) AS x, octet_length(encode(f)) AS n FROM (SELECT f FROM own UNION SELECT f FROM theirs)),
k AS (SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, n), lambda j: CAST(16 * (instr('0123456789ABCDEF', x[2 * j + 1]) - 1) + instr('0123456789ABCDEF', x[2 * j + 2]) - 1 AS BIGINT))), lambda c, y: xor(t[1 + (xor(c, y) & 255)], c >> 8))) % 10000 AS k FROM h, tab),
s AS (SELECT k, sum(n) AS s FROM own JOIN k USING (f) GROUP BY k),
t AS (SELECT k, sum(n) AS t FROM theirs JOIN k USING (f) GROUP BY k),
g AS (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000.0::DOUBLE) / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000.0::DOUBLE)))) AS g FROM s FULL JOIN t USING (k)),
v AS (SELECT r, sum(n) AS n_features, CAST(floor(sum(g * n) / sum(n)) AS BIGINT) AS weight FROM own JOIN k USING (f) JOIN g USING (k) GROUP BY r),
z AS (SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN v USING (r)),
o AS (SELECT doc_id, n_features, weight, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM z WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) * 25 // 100 FROM o) THEN rank END AS rank FROM o UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM z WHERE n_words < 20"""

#: Encoding, curves, models and rolling hashes can't be put in SQL; those queries are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op1_line_dedup": _LINES, "line_links": _LINE_LINKS, "op2_decontaminate": _LEAKS, "op4_minhash": _NEAR, "op11_importance": _GUMBEL, "op12_rowmatch": _MATCHES}
