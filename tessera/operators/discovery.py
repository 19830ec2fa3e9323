"""Finding reports: links on portal pages, search hits, and a cache with a time to live."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import links as L
from tessera.sources.fetched import SEARCH

# Hits per query, and how long a found link is kept.
MAX_RESULTS, CACHE_DAYS = 10, 30
# The issuers covered by default and their domains.
DOMAINS = {"VNM": "vinamilk.com.vn", "FPT": "fpt.com.vn", "HPG": "hoaphat.com.vn", "VCB": "vietcombank.com.vn", "MWG": "mwg.vn"}


def document_links(pages: DataFrame, id_col: str, url_col: str, html_col: str, link: str = L.LINK, label: str = L.LABEL, strict: bool = True) -> DataFrame:
    """(id, pos, href, label) of the links whose target and label both match (either, unless strict), in page order, made absolute."""
    rows = pages.select(id_col, F.col(url_col).alias("_base"), F.posexplode(L.anchors(F.col(html_col))).alias("pos", "a")).select(id_col, "_base", "pos", "a.*")
    rows = rows.filter(L.is_report_link(F.col("href"), F.col("label"), link, label, strict))
    return rows.select(id_col, "pos", L.resolve(F.col("_base"), F.col("href")).alias("href"), "label")


def pick_report(hits: DataFrame, query_col: str, limit: int = MAX_RESULTS) -> DataFrame:
    """(query, url) from (query, pos, href, official_domain): the first trusted PDF, or else the first PDF; piracy hosts never; null if there is none."""
    host = L.hostname(F.col("href"))
    rows = hits.filter(F.col("pos") < limit).withColumn("_ok", F.coalesce((F.col("href") != "") & host.isNotNull() & ~L.is_piracy(host) & L.is_pdf(F.col("href")), F.lit(False)))
    best = F.min(F.when(F.col("_ok"), F.struct((~L.is_trusted(F.col("href"), F.col("official_domain"))).alias("untrusted"), "pos", "href")))
    return rows.groupBy(query_col).agg(best.alias("_b")).select(query_col, F.col("_b.href").alias("url"))


def with_domain(tickers: DataFrame, domains: DataFrame) -> DataFrame:
    """tickers (ticker, ...) with their official domain, {ticker}.com.vn by default."""
    known = domains.select(F.col("ticker").alias("_t"), "domain")
    return tickers.join(known, F.col("ticker") == F.col("_t"), "left").withColumn("domain", F.coalesce("domain", F.concat(F.lower("ticker"), F.lit(".com.vn")))).drop("_t")


def search_query(ticker: Column, year: Column) -> Column:
    return F.format_string(SEARCH.replace("{}", "%s"), ticker, year.cast("string"))


def cached_search(requests: DataFrame, cache: DataFrame, hits: DataFrame, now: Column, days: int = CACHE_DAYS) -> DataFrame:
    """(ticker, year, url, cached), a row for each (ticker, year) that is asked, however often: from cache (ticker, year, url, at) while fresh, else picked from hits (ticker, year, pos, href, official_domain). Of cache rows of one time the largest url counts."""
    fresh = cache.filter(F.col("url").isNotNull() & (F.col("at") > now - F.expr(f"interval {days} days"))).groupBy("ticker", "year").agg(F.max(F.struct("at", "url"))["url"].alias("cached_url"))
    asked = requests.select("ticker", "year").distinct().join(fresh, ["ticker", "year"], "left")
    key = F.concat_ws("\x1f", "ticker", F.col("year").cast("string"))
    missing = hits.join(asked.filter("cached_url is null").select("ticker", "year"), ["ticker", "year"], "left_semi").withColumn("_key", key)
    picked = pick_report(missing, "_key")
    out = asked.withColumn("_key", key).join(picked, "_key", "left")
    return out.select("ticker", "year", F.coalesce("cached_url", "url").alias("url"), F.col("cached_url").isNotNull().alias("cached"))


def blocked(rows: DataFrame, url_col: str, blocklist: DataFrame) -> DataFrame:
    """rows with the entry of blocklist (host) that a url's host is or lies under, the longest one, or null.

    Each host is expanded to what it lies under, so a list of any size is met by equality; only distinct hosts take part
    in that, so neither a host that a third of all rows share nor the list meets in one task.
    """
    own = rows.withColumn("_host", L.hostname(F.col(url_col)))
    ends = own.select("_host").filter("_host is not null").distinct().select("_host", F.posexplode(L.suffixes(F.col("_host"))).alias("_nth", "_end"))
    listed = blocklist.select(F.lower("host").alias("_listed")).distinct()
    met = ends.join(listed, F.col("_end") == F.col("_listed")).groupBy(F.col("_host").alias("_of")).agg(F.min_by("_end", "_nth").alias("blocked_by"))
    return own.join(met, F.col("_host") == F.col("_of"), "left").drop("_host", "_of")


def before_halt(calls: DataFrame, run_col: str, pos_col: str, failed: Column) -> DataFrame:
    """Circuit breaker: of each run the calls before its first failure, found by aggregation, so that runs may be of any length."""
    first = calls.filter(failed).groupBy(F.col(run_col).alias("_run")).agg(F.min(pos_col).alias("_halt"))
    return calls.join(first, F.col(run_col) == F.col("_run"), "left").filter(F.col("_halt").isNull() | (F.col(pos_col) < F.col("_halt"))).drop("_run", "_halt")

