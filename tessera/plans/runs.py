"""The scheduled runs, each as one batch plan over landed tables: crawling for reports, quantitative scans, news."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import dedup, discovery, lifecycle, quant
from tessera.sources import landed
from tessera.sources.files import extracted
from tessera.sources.keyed import KeyedTable
from tessera.sources.shared import cut

# What a crawled report is taken for, and the reason in the dead letters of a halted run.
REPORT_FLAG, QUOTA_REASON = "TEXT_BASED", "ddg_ratelimit"


class Crawl(NamedTuple):
    """outcomes (ticker, year, pos, url, outcome), documents after the run, new cache rows, dead letters."""

    outcomes: DataFrame
    documents: DataFrame
    cache: DataFrame
    dead: DataFrame

    def counters(self) -> DataFrame:
        """One row: saved, skipped, failed."""
        kinds = ("saved", "skipped", "failed")
        return self.outcomes.agg(*(F.count_if(F.col("outcome") == k).alias(k) for k in kinds))


def crawl_reports(requests: DataFrame, cache: DataFrame, hits: DataFrame, quota: DataFrame, files: DataFrame, documents: DataFrame, now: Column) -> Crawl:
    """Each request (ticker, year, pos), in the order of pos: its report is found, fetched, held against known contents and stored.

    A fresh cache row (ticker, year, url, at) answers without a search; else the report is picked from hits (ticker,
    year, pos, href, official_domain). Where such a search met its quota (quota: ticker, year), the run ends: that
    request is a dead letter and later ones aren't tried. files (url, content_hash, error) are what was fetched: a url
    without a row or with an error has failed; of several rows without an error the least hash counts. A content that
    documents (doc_id, content_hash, state, ...) hold, or an earlier request brought, is skipped, as is a request without
    a url; a ticker's year that is asked again brings its own content again. Requests of one pos come in the order of
    ticker and year. A document whose state can't become DOWNLOADED takes the new content but counts as failed.

    Found urls and outcomes are used several times, so both are held in shared storage.
    """
    again = F.row_number().over(Window.partitionBy("ticker", "year").orderBy("pos"))
    requests = requests.select("ticker", "year", "pos", again.alias("_nth"))
    found = cut(discovery.cached_search(requests, cache, hits, now))
    met = quota.select(F.col("ticker").alias("_t"), F.col("year").alias("_y"), F.lit(True).alias("_met")).distinct()
    tried = requests.join(found, ["ticker", "year"]).join(met, (F.col("ticker") == F.col("_t")) & (F.col("year") == F.col("_y")), "left").withColumn("_halts", F.coalesce("_met", F.lit(False)) & ~F.col("cached")).drop("_t", "_y", "_met")
    tried = tried.withColumn("_at", F.struct("pos", "ticker", "year", "_nth"))
    halt = tried.filter("_halts").agg(F.min("_at").alias("_halt"))  # one row
    tried = cut(tried.join(F.broadcast(halt), F.lit(True)))
    dead = tried.filter("_at = _halt").select("ticker", "year", F.lit(QUOTA_REASON).alias("reason"))
    tried = tried.filter("_halt is null or _at < _halt").select("ticker", "year", "pos", "_at", "url", "cached", lifecycle.doc_key(F.col("ticker"), F.col("year")).alias("doc_id"))

    got = files.groupBy(F.col("url").alias("_url")).agg(F.min(F.when(F.col("error").isNull(), F.col("content_hash"))).alias("_hash"))
    tried = tried.join(got, F.col("url") == F.col("_url"), "left")
    first = tried.filter("_hash is not null").groupBy(F.col("_hash").alias("_h")).agg(F.min("_at").alias("_first"))
    known = documents.filter("content_hash is not null").select(F.col("content_hash").alias("_k")).distinct()
    states = documents.select(F.col("doc_id").alias("_d"), F.col("state").alias("_state"))
    tried = tried.join(first, F.col("_hash") == F.col("_h"), "left").join(known, F.col("_hash") == F.col("_k"), "left").join(states, F.col("doc_id") == F.col("_d"), "left")
    moves = F.coalesce(lifecycle.can_move(F.coalesce("_state", F.lit(lifecycle.STATES[0])), F.lit("DOWNLOADED")), F.lit(False))
    stored = F.col("url").isNotNull() & F.col("_hash").isNotNull() & F.col("_k").isNull() & (F.col("_at") == F.col("_first"))
    outcome = F.when(F.col("url").isNull(), "skipped").when(F.col("_hash").isNull(), "failed").when(stored & moves, "saved").when(stored, "failed").otherwise("skipped")
    tried = cut(tried.withColumn("outcome", outcome).withColumn("_stored", F.coalesce(stored, F.lit(False))).withColumn("_moves", moves))

    path = F.concat(F.lit("reports/"), F.col("ticker"), F.lit("/"), F.col("year").cast("string"), F.lit(".pdf"))
    last = tried.filter("_stored").groupBy("doc_id").agg(F.max_by(F.struct("ticker", "year", "_hash", "_moves", "_state"), "_at").alias("_r")).select("doc_id", "_r.*")
    changes = last.select("doc_id", F.lit(REPORT_FLAG).alias("pdf_type_flag"), F.col("_hash").alias("content_hash"), path.alias("storage_path"), F.when(F.col("_moves"), "DOWNLOADED").otherwise(F.col("_state")).alias("state"))
    after = lifecycle.merged(documents, changes, "doc_id", ["pdf_type_flag", "content_hash", "storage_path", "state"])
    fresh = tried.filter("url is not null and not cached").select("ticker", "year", "url", now.alias("at")).distinct()
    return Crawl(tried.select("ticker", "year", "pos", "url", "outcome"), after, fresh, dead)


def scan_quantitative(tickers: DataFrame, profit: DataFrame, assets: DataFrame, fallback: DataFrame, year: int) -> tuple[DataFrame, DataFrame]:
    """(rows, counters): both metrics of each ticker (symbol) in a year, from the statements or else the fallback rows (symbol, year, metric, value); a ticker that neither has anything of has failed, which is no failure of the others."""
    asked = cut(tickers.select("symbol").distinct())
    profit, assets = cut(profit), cut(assets)  # each is used several times
    have = profit.select("symbol").unionByName(assets.select("symbol")).distinct()
    own = quant.report(profit, assets, asked.join(have, "symbol", "left_semi").withColumn("year", F.lit(year)))
    backup = fallback.filter(F.col("year") == year).join(asked, "symbol", "left_semi")
    rows = cut(quant.with_fallback(own, backup, ["symbol"]))
    done = rows.select("symbol").distinct().withColumn("_done", F.lit(1))
    return rows, asked.join(done, "symbol", "left").agg(F.count("*").alias("total"), F.count_if(F.col("_done").isNull()).alias("failed"))


def poll_news(feeds: dict[str, DataFrame], text_col: str, order_col: str, seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new, seen): of all feeds' items the first of each content that `seen` (content_hash) doesn't hold, and the contents seen afterwards. Feeds count in their order."""
    items = landed.united(feeds)
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in zip(feeds, range(len(feeds)), strict=True) for x in pair]), F.col("source"))
    items = items.withColumn("_order", F.struct(rank.alias("feed"), F.col(order_col).isNull().alias("late"), F.col(order_col).alias("at")))
    new = dedup.new_items(items, text_col, "_order", seen).drop("_order")
    now = new.select("content_hash")
    return new, now if seen is None else seen.select("content_hash").unionByName(now)


def rss(spark: SparkSession, paths: dict[str, str], seen_path: str) -> int:
    """Polls landed feeds once: contents not in the table at seen_path are appended to it; how many there were."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(seen_path)
    seen = spark.read.schema("content_hash string").parquet(seen_path) if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at) else None
    items = landed.feeds(spark, paths)
    new, _ = poll_news({s: items.filter(F.col("source") == s).drop("source") for s in paths}, "body_text", "link", seen)
    counted = Observation()
    new.select("content_hash").observe(counted, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(seen_path)
    return counted.get["n"]


def crawl(requests: DataFrame, hits: DataFrame, quota: DataFrame, files: DataFrame, documents: KeyedTable, cache: KeyedTable, now: Column, dead_path: str, alert: Callable[[int, int], object] | None = None) -> dict[str, int]:
    """crawl_reports() against the written tables: stored documents (PENDING where they're new), cache rows and dead letters are written, and `alert` is told how many of how many failed. The counters.

    documents is a table of sources.keyed.DOCUMENTS, cache one of CACHE. Each table changes in one commit; a run that
    dies before it has changed neither, and is simply run again: contents that were stored are skipped then.
    """
    kept = cache.read().select(F.regexp_extract("cache_key", r"(?s)^search_(.*)_(-?[0-9]+)$", 1).alias("ticker"), F.regexp_extract("cache_key", r"(?s)^search_(.*)_(-?[0-9]+)$", 2).cast("int").alias("year"), "url", "at")
    done = crawl_reports(requests, kept, hits, quota, files, documents.read().select("doc_id", "pdf_type_flag", "content_hash", "storage_path", "state"), now)
    key = lambda t, y: F.concat(F.lit("search_"), t, F.lit("_"), y.cast("string"))
    cache.upsert(done.cache.select(key(F.col("ticker"), F.col("year")).alias("cache_key"), "url", "at"))
    names = done.outcomes.select(lifecycle.doc_key(F.col("ticker"), F.col("year")).alias("_id"), "ticker", F.col("year").alias("fiscal_year")).distinct()
    changed = done.documents.join(names, F.col("doc_id") == F.col("_id")).filter("storage_path is not null").drop("_id")
    documents.upsert(changed.withColumn("updated_at", now), {"state": lifecycle.STATES[0]})
    done.dead.write.mode("append").parquet(dead_path)
    n = done.counters().first().asDict()
    if alert:
        alert(n["failed"], max(1, requests.select("ticker", "year").distinct().count()))
    return n


#: How often a failed document is tried again.
RETRIES = 2


def attempts(todo: DataFrame, key: str, work: Callable[[DataFrame, int], DataFrame], retries: int = RETRIES) -> tuple[DataFrame, DataFrame]:
    """(results, ledger): work(rows, attempt) gives for each row of todo its columns and `error`; rows with one are tried again, `retries` times at most.

    results has the last try of each row; ledger (key, attempt, error) has them all. Each try is computed once, however
    often its results are used.
    """
    results = ledger = None
    for n in range(1, retries + 2):
        tried = cut(work(todo, n))
        own = tried.select(key, F.lit(n).alias("attempt"), "error")
        ledger = own if ledger is None else ledger.unionByName(own)
        final = tried if n > retries else tried.filter("error is null")
        results = final if results is None else results.unionByName(final)
        bad = tried.filter("error is not null").select(F.col(key).alias("_again"))
        if n > retries or bad.isEmpty():
            break
        todo = todo.join(bad, F.col(key) == F.col("_again"), "left_semi")
    return results, ledger


def process_documents(files: DataFrame, documents: KeyedTable, ledger_path: str, now: Column, text: Callable | None = None, scan: Callable | None = None) -> DataFrame:
    """(path, raw_text, tables) of what could be extracted from files (path, content, pdf_type_flag) of the table's documents that are DOWNLOADED.

    A document (found by its storage_path) whose extraction fails is tried twice more; then it's in ERROR with the last
    message, for good; the others are EXTRACTED. All attempts are added to the ledger. The extractor runs once for each
    file and attempt; the states change in one commit.
    """
    due = documents.read().filter((F.col("state") == "DOWNLOADED") & F.col("storage_path").isNotNull()).select("doc_id", F.col("storage_path").alias("_path"))
    todo = cut(files.join(due.select("_path").distinct(), F.col("path") == F.col("_path"), "left_semi"))
    results, ledger = attempts(todo, "path", lambda rows, _: extracted(rows, text, scan))
    ledger.withColumn("at", now).write.mode("append").parquet(ledger_path)
    moved = results.join(due, F.col("path") == F.col("_path")).select("doc_id", F.when(F.col("error").isNull(), "EXTRACTED").otherwise(lifecycle.ERROR).alias("state"), F.col("error").alias("error_message"), now.alias("updated_at"))
    documents.upsert(moved)
    return results.filter("error is null").drop("error")
