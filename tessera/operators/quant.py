"""Factor inputs: statements by year, price bars by month, market equity, growth and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import ordered

# The line items.
OPERATING_PROFIT, TOTAL_ASSETS = "Operating profit/(loss)", "Total Assets"


def line_item(statement: DataFrame, item: str, value: str, key: str = "symbol", order: str | None = None) -> DataFrame:
    """(key, year, value) from a wide statement (key, item_en, one column a year): the first row of the item by order (or as the rows come, which holds for sources that keep an order alone), unpivoted; cells that aren't numbers are left out."""
    years = [c for c in statement.columns if c.isdigit()]
    if not years:
        return statement.select(key, F.lit(0).alias("year"), F.lit(0.0).alias(value)).filter("false")
    place = F.col(order) if order else F.monotonically_increasing_id()
    rows = statement.withColumn("_place", place).filter(F.trim(F.lower("item_en")) == item.lower())
    rows = rows.groupBy(key).agg(F.min_by(F.struct(*(F.col(f"`{y}`").cast("string").alias(y) for y in years)), "_place").alias("_row"))
    rows = rows.select(key, *(F.col(f"_row.`{y}`").alias(y) for y in years))
    long = rows.unpivot(key, years, "year", "_cell")
    return long.select(key, F.col("year").cast("int").alias("year"), F.col("_cell").try_cast("double").alias(value)).filter(F.col(value).isNotNull())


def growth(value: Column, key: str = "symbol", order: str = "year", pad: bool = True) -> Column:
    """value / the value before it - 1, by the years there are; NaN for the first; with pad a NaN is carried over from the last value. A zero before gives an infinity, or NaN for 0/0."""
    w = Window.partitionBy(key).orderBy(order)
    nan = F.lit(float("nan"))
    if pad:
        value = F.coalesce(F.last(F.when(~F.isnan(value), value), ignorenulls=True).over(w), nan)
    before = F.lag(value).over(w)
    inf = F.when(F.isnan(value) | (value == 0), nan).when(value > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    return F.when(before.isNull() | F.isnan(before), nan).when(before == 0, inf).otherwise(F.try_divide(value, before) - 1)


def yearly(profit: DataFrame, assets: DataFrame, key: str = "symbol") -> DataFrame:
    """(key, year, operating_profit, total_assets, asset_growth) of every year that either has."""
    grown = assets.withColumn("asset_growth", growth(F.col("total_assets"), key))
    return profit.join(grown, [key, "year"], "full").select(key, "year", "operating_profit", "total_assets", "asset_growth")


def report(profit: DataFrame, assets: DataFrame, asked: DataFrame, key: str = "symbol") -> DataFrame:
    """(key, year, metric, value) of both metrics for each asked (key, year); a missing year has a null value."""
    rows = asked.select(key, "year").join(profit, [key, "year"], "left").join(assets, [key, "year"], "left")
    return rows.unpivot([key, "year"], ["operating_profit", "total_assets"], "metric", "value")


def with_fallback(primary: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """primary, and the fallback rows of the keys that primary hasn't."""
    return primary.unionByName(fallback.join(primary.select(*keys).distinct(), keys, "left_anti"))


def monthly_bars(ticks: DataFrame, key: str, time: str, price: str, volume: str | None = None) -> DataFrame:
    """(key, month, open, high, low, close, volume) of each month; ties in time go to the smaller price first and the larger last."""
    at = F.struct(time, price)
    return ticks.groupBy(key, F.date_trunc("month", time).alias("month")).agg(F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), (F.sum(volume) if volume else F.count(price)).alias("volume"))


def shares(overview: DataFrame, key: str = "symbol", order: str | None = None) -> DataFrame:
    """(key, shares): the issue_share of an issuer's first overview row by order (or as the rows come) as a number, or null."""
    own = F.struct(F.col("issue_share").cast("string").try_cast("double").alias("shares"))
    rows = overview.select(key, own.alias("_own"), (F.col(order) if order else F.monotonically_increasing_id()).alias("_place"))
    return rows.groupBy(key).agg(F.min_by("_own", "_place").alias("_own")).select(key, "_own.shares")


def market_equity(bars: DataFrame, share_rows: DataFrame, key: str = "symbol") -> DataFrame:
    """bars with market_equity = close x the issuer's (current) shares."""
    return bars.join(share_rows, key, "left").withColumn("market_equity", F.col("close").cast("double") * F.col("shares"))


def market_equity_asof(bars: DataFrame, share_rows: DataFrame, key: str = "symbol", time: str = "time", hot: int = ordered.HOT) -> DataFrame:
    """bars with shares and market_equity by the issuer's shares (key, time, shares) of their time: the last count at or before each; an issuer of `hot` rows or more is split."""
    return ordered.asof(bars, share_rows, [key], time, ["shares"], hot=hot).withColumn("market_equity", F.col("close").cast("double") * F.col("shares"))


def summary(bars: DataFrame, share_rows: DataFrame, assets: DataFrame, key: str = "symbol") -> DataFrame:
    """(key, shares_outstanding, last_close, market_cap_est, years_of_financials); a close or share count of 0 counts as missing for the estimate."""
    last = bars.groupBy(key).agg(F.max_by("close", "month").alias("last_close"))
    years = assets.groupBy(key).agg(F.count_distinct("year").alias("years_of_financials"))
    rows = last.join(share_rows, key, "full").join(years, key, "left")
    cap = F.when((F.col("last_close") != 0) & (F.col("shares") != 0), F.col("last_close") * F.col("shares"))
    return rows.select(key, F.col("shares").alias("shares_outstanding"), "last_close", cap.alias("market_cap_est"), F.coalesce("years_of_financials", F.lit(0)).alias("years_of_financials"))


def factor_inputs(income: DataFrame, balance: DataFrame, bars: DataFrame, overview: DataFrame, key: str = "symbol") -> dict[str, DataFrame]:
    """The yearly and monthly inputs of all issuers, and their summary."""
    profit, assets, own = line_item(income, OPERATING_PROFIT, "operating_profit", key), line_item(balance, TOTAL_ASSETS, "total_assets", key), shares(overview, key)
    return {"yearly": yearly(profit, assets, key), "monthly": market_equity(bars, own, key), "summary": summary(bars, own, assets, key)}
