"""Sector metrics and dashboard queries (A-1..A-4, Q-1..Q-6).

Sector windows run after the (date, sector) aggregation: each window
partition is one sector's daily series (bounded by the calendar).
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.columns import safe_divide
from marketlake.operators.dedup import dedup_latest
from marketlake.operators.timeseries import cumulative

# Trading days per year used to annualise.
TRADING_DAYS = 252


def sector_daily(fact: DataFrame) -> DataFrame:
    """A-1: equal-weighted mean returns per (date, sector)."""
    return (
        fact.where(F.col("sector").isNotNull())
        .groupBy("date_key", "sector")
        .agg(F.avg("daily_return").alias("avg_daily_return"), F.avg("log_return").alias("avg_log_return"))
    )


def sector_cumulative_return(daily: DataFrame) -> DataFrame:
    """W-7: compounded sector return over the sector's daily means."""
    return daily.withColumn("cumulative_return", cumulative("avg_log_return", key="sector"))


def sector_performance(fact: DataFrame) -> DataFrame:
    """A-2: daily sector returns and cumulative performance (flagship)."""
    s = sector_cumulative_return(sector_daily(fact))
    return s.select(
        "date_key", "sector", "avg_daily_return",
        (F.col("avg_daily_return") * 100).alias("avg_daily_return_pct"),
        "cumulative_return",
        (F.col("cumulative_return") * 100).alias("cumulative_return_pct"),
    )


def twelve_months_before(as_of: dt.date) -> F.Column:
    return F.add_months(F.lit(as_of).cast("date"), -12)


def sector_volatility(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """A-3: annualised return, volatility and their ratio since as_of - 12 months."""
    agg = (
        fact.where(F.col("sector").isNotNull() & (F.col("date_key") >= twelve_months_before(as_of)))
        .groupBy("sector")
        .agg(F.avg("daily_return").alias("avg_daily_return"),
             F.stddev_pop("daily_return").alias("stddev_daily_return"))
    )
    ann_ret = F.col("avg_daily_return") * TRADING_DAYS
    ann_vol = F.col("stddev_daily_return") * math.sqrt(TRADING_DAYS)
    return agg.select(
        "sector", ann_ret.alias("annualized_return"), ann_vol.alias("annualized_volatility"),
        safe_divide(ann_ret, ann_vol).alias("return_risk_ratio"),
    )


def monthly_top_worst_sector(fact: DataFrame) -> DataFrame:
    """A-4: best and worst sector per calendar month.

    Our definition (the source only names this asset): compound each sector's
    daily mean log return within the month; best = highest, worst = lowest,
    ties to the alphabetically first sector.  Picked with ``min(struct)``
    aggregates, so no per-month ranking window is needed.
    """
    monthly = (
        sector_daily(fact)
        .groupBy(F.trunc("date_key", "month").alias("month_start"), "sector")
        .agg((F.exp(F.sum(F.coalesce(F.col("avg_log_return"), F.lit(0.0)))) - 1).alias("monthly_return"))
    )
    picked = monthly.groupBy("month_start").agg(
        F.min(F.struct((-F.col("monthly_return")).alias("k"), F.col("sector"), F.col("monthly_return"))).alias("best"),
        F.min(F.struct(F.col("monthly_return").alias("k"), F.col("sector"), F.col("monthly_return"))).alias("worst"),
    )
    return picked.select(
        "month_start",
        F.col("best.sector").alias("best_sector"), F.col("best.monthly_return").alias("best_return"),
        F.col("worst.sector").alias("worst_sector"), F.col("worst.monthly_return").alias("worst_return"),
    )


def _rank_small(df: DataFrame, order_cols) -> DataFrame:
    """Rank a per-sector result (one row per sector: bounded by the sector
    list, a handful of rows), so a single ordered window is harmless."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order_cols)).cast("long"))


def sector_outperformance_12m(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Q-1: sectors ranked by compounded return over (as_of - 12 months, as_of]."""
    d = sector_daily(fact).where(
        (F.col("date_key") >= twelve_months_before(as_of)) & (F.col("date_key") <= F.lit(as_of).cast("date"))
    )
    per = d.groupBy("sector").agg(
        (F.exp(F.sum(F.coalesce(F.col("avg_log_return"), F.lit(0.0)))) - 1).alias("return_12m"),
        F.count(F.lit(1)).alias("n_days"),
    )
    return _rank_small(per, [F.col("return_12m").desc(), F.col("sector")])


def sector_volatility_ranking(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """Q-2: A-3 with its rank by annualised volatility (highest first)."""
    return _rank_small(sector_volatility(fact, as_of),
                       [F.col("annualized_volatility").desc_nulls_last(), F.col("sector")])


def sector_return_series(fact: DataFrame) -> DataFrame:
    """Q-3: cumulative return series per sector for charting."""
    return sector_performance(fact).select("sector", "date_key", "cumulative_return_pct", "avg_daily_return_pct")


def price_history(fact: DataFrame, start: dt.date, end: dt.date, symbols=None) -> DataFrame:
    """Q-4: price fact for a date range (and optional symbols).

    On a fact written with ``partitionBy('date_key')`` the date predicate
    becomes a PartitionFilter and the symbol predicate a pushed filter.
    """
    cond = F.col("date_key").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if symbols:
        cond = cond & F.col("symbol").isin(list(symbols))
    return fact.where(cond)


def company_news_range(news: DataFrame, start: dt.date, end: dt.date, symbols=None) -> DataFrame:
    """Q-5: news for a period (and optional symbols)."""
    return price_history(news, start, end, symbols)


def by_dates(fact: DataFrame, dates: DataFrame, symbols=None) -> DataFrame:
    """Q-4 / Q-5 for the days that a selection of the date dimension names (a
    quarter, trading days, ISO weeks), which no literal range can.

    A semi join on the partition column: the days selected are found first and
    prune the fact's partitions at run time (dynamic partition pruning), so only
    their folders are read."""
    chosen = fact if not symbols else fact.where(F.col("symbol").isin(list(symbols)))
    return chosen.join(dates.select("date_key"), "date_key", "left_semi").select(*fact.columns)


def compare_financials(fin: DataFrame, companies: DataFrame) -> DataFrame:
    """Q-6: latest indicators per company with its sector."""
    latest = dedup_latest(fin, ["symbol"], ["date_key", "_loaded_at"])
    comp = companies.select("symbol", "company_name", "sector")
    return latest.join(comp, "symbol", "left").select(
        "symbol", "company_name", "sector", F.col("date_key").alias("as_of_date"),
        "pe_ratio", "pb_ratio", "eps_ttm", "dividend_yield", "beta", "market_cap",
    )
