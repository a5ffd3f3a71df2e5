"""Star-schema marts: companies, dates, facts (M-1..M-10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.columns import canonical_share_class, normalize_symbol, surrogate_key, ts_text
from marketlake.operators.dedup import dedup_latest
from marketlake.operators.timeseries import price_features

PROFILE_COLUMNS = ["company_name", "industry", "country", "market_cap", "ipo_date",
                   "logo_url", "web_url", "exchange", "_loaded_at"]

FACT_PRICE_COLUMNS = ["symbol", "date_key", "sector", "open", "high", "low", "close", "volume",
                      "daily_return", "log_return", "cumulative_return", "volume_sma_20",
                      "volume_zscore", "_loaded_at"]

FACT_FIN_COLUMNS = ["symbol", "date_key", "pe_ratio", "pb_ratio", "eps_ttm", "dividend_yield",
                    "beta", "week_52_high", "week_52_low", "market_cap", "_loaded_at"]

FACT_NEWS_COLUMNS = ["news_id", "symbol", "date_key", "news_ts", "headline", "summary", "source",
                     "category", "url", "image", "_loaded_at"]


def dim_companies(seed: DataFrame, profiles: DataFrame) -> DataFrame:
    """M-1: seed-driven company dimension.

    Every seed row is kept; the newest staged profile (share class
    canonicalised) is attached; ``company_name`` falls back to the symbol and
    the sector always comes from the seed.
    """
    s = seed.select(normalize_symbol("symbol").alias("symbol"), "sector")
    p = profiles.select(canonical_share_class("symbol").alias("symbol"), *PROFILE_COLUMNS)
    newest = dedup_latest(p, ["symbol"], ["_loaded_at"])
    j = s.join(newest, "symbol", "left")
    return j.select(
        "symbol", F.coalesce(F.col("company_name"), F.col("symbol")).alias("company_name"), "sector",
        "industry", "country", "market_cap", "ipo_date", "logo_url", "web_url", "exchange", "_loaded_at",
    )


def date_union(candles: DataFrame, financials: DataFrame, news: DataFrame | None = None) -> DataFrame:
    """M-2: every date key of the staged sources (UNION ALL)."""
    out = candles.select("date_key").unionByName(financials.select("date_key"))
    if news is not None:
        out = out.unionByName(news.select("date_key"))
    return out


def date_bounds(dates: DataFrame, as_of: dt.date) -> DataFrame:
    """M-3: one row (min_date, max_date), defaults when there are no dates."""
    as_of_c = F.lit(as_of).cast("date")
    return dates.agg(
        F.coalesce(F.min("date_key"), F.date_sub(as_of_c, 365)).alias("min_date"),
        F.coalesce(F.max("date_key"), as_of_c).alias("max_date"),
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """M-4: one row per calendar day between the bounds, inclusive.

    Empty when min > max (Spark's ``sequence`` would count down).
    """
    days = F.when(F.col("min_date") <= F.col("max_date"), F.sequence("min_date", "max_date"))
    return bounds.select(F.explode(days).alias("date_key"))


def trading_days(candles: DataFrame) -> DataFrame:
    """M-5: distinct candle dates."""
    return candles.select("date_key").distinct()


def dim_dates(candles: DataFrame, financials: DataFrame, news: DataFrame | None, as_of: dt.date) -> DataFrame:
    """M-6: calendar attributes and a trading flag for every spine day.

    Both sides are bounded by the number of calendar days in the spine; the
    planner broadcasts the trading-day set under its size threshold.
    """
    spine = date_spine(date_bounds(date_union(candles, financials, news), as_of))
    td = trading_days(candles).withColumn("_trading", F.lit(True))
    d = F.col("date_key")
    return spine.join(td, "date_key", "left").select(
        d,
        F.year(d).cast("long").alias("year"),
        F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"),
        F.weekofyear(d).cast("long").alias("week_of_year"),
        F.dayofweek(d).cast("long").alias("day_of_week"),
        F.coalesce(F.col("_trading"), F.lit(False)).alias("is_trading"),
    )


def fct_daily_prices(stg: DataFrame, companies: DataFrame) -> DataFrame:
    """M-7: returns + volume stats + cumulative return, with the sector.

    One shuffle on ``symbol`` feeds all windows (no self-join of the volume
    statistics).  The window output is already hash-partitioned and sorted by
    ``symbol``, so a sort-merge join with the company dimension shuffles only
    the dimension; AQE turns it into a broadcast join when the dimension's
    measured size is under the threshold.  No hint: nothing is broadcast on
    an unproven size.
    """
    feats = price_features(stg)
    comp = companies.select("symbol", "sector")
    return feats.join(comp, "symbol", "left").select(*FACT_PRICE_COLUMNS)


def fct_company_financials(stg_fin: DataFrame) -> DataFrame:
    """M-8: projection of the staged financials."""
    return stg_fin.select(*FACT_FIN_COLUMNS)


def news_surrogate_key() -> F.Column:
    """M-9: NULL-safe hash of (symbol, news time as text, headline, url)."""
    return surrogate_key("symbol", ts_text("news_ts"), "headline", "url")


def fct_company_news(stg_news: DataFrame) -> DataFrame:
    """M-10: staged news with its surrogate key."""
    return stg_news.withColumn("news_id", news_surrogate_key()).select(*FACT_NEWS_COLUMNS)
