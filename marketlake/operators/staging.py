"""Staging transforms: normalise, cast, deduplicate, classify (T-1..T-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.columns import (
    canonical_share_class,
    col_or_null,
    normalize_symbol,
    round_to_long,
    utc_date,
)
from marketlake.functions.sectors import classify_sector
from marketlake.operators.dedup import dedup_latest

# Legacy and current column names of the 52-week range in raw financials.
WEEK52_HIGH_NAMES = ("52_week_high", "week_52_high")
WEEK52_LOW_NAMES = ("52_week_low", "week_52_low")


def stg_candles(raw: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """T-4: newest load per (symbol, trading day), then validity filters.

    Dedup happens before the ``close``/``volume`` filters, so a key whose
    newest load is invalid disappears.  NULL symbols form their own group
    and are dropped anyway, so that filter runs before the shuffle.
    """
    base = raw.where(F.col("symbol").isNotNull()).select(
        normalize_symbol("symbol").alias("symbol"),
        utc_date(raw, "trading_date").alias("date_key"),
        F.col("open").cast("double").alias("open"),
        F.col("high").cast("double").alias("high"),
        F.col("low").cast("double").alias("low"),
        F.col("close").cast("double").alias("close"),
        F.col("volume").cast("double").alias("volume"),
        F.col("_loaded_at"),
        *[F.col(c) for c in tiebreak],
    )
    latest = dedup_latest(base, ["symbol", "date_key"], ["_loaded_at", *tiebreak])
    return latest.select(
        "symbol", "date_key", "open", "high", "low", "close",
        round_to_long("volume").alias("volume"), "_loaded_at",
    ).where(F.col("close").isNotNull() & (F.col("volume") > 0))


def week52_coalesce(df: DataFrame, names: Sequence[str]) -> F.Column:
    """T-5: first non-NULL of columns that may or may not exist, as double.

    The schema is known when the plan is built, so a missing column is
    resolved to a typed NULL instead of serialising every row to JSON.
    """
    return F.coalesce(*[col_or_null(df, n, "double").cast("double") for n in names])


def stg_company_financials(raw: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """T-6: canonical symbol, load date as key, 52-week coalesce, dedup."""
    norm = raw.where(F.col("symbol").isNotNull()).select(
        canonical_share_class("symbol").alias("symbol"),
        utc_date(raw, "_loaded_at").alias("date_key"),
        col_or_null(raw, "pe_ratio", "double").cast("double").alias("pe_ratio"),
        col_or_null(raw, "pb_ratio", "double").cast("double").alias("pb_ratio"),
        col_or_null(raw, "eps_ttm", "double").cast("double").alias("eps_ttm"),
        col_or_null(raw, "dividend_yield", "double").cast("double").alias("dividend_yield"),
        col_or_null(raw, "beta", "double").cast("double").alias("beta"),
        week52_coalesce(raw, WEEK52_HIGH_NAMES).alias("week_52_high"),
        week52_coalesce(raw, WEEK52_LOW_NAMES).alias("week_52_low"),
        col_or_null(raw, "market_cap", "double").cast("double").alias("market_cap"),
        F.col("_loaded_at"),
        *[F.col(c) for c in tiebreak],
    )
    latest = dedup_latest(norm, ["symbol", "date_key"], ["_loaded_at", *tiebreak])
    return latest.drop(*tiebreak)


def stg_company_news(raw: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """T-7: newest load per (symbol, time, url-or-headline)."""
    base = raw.where(F.col("symbol").isNotNull() & F.col("datetime").isNotNull()).select(
        normalize_symbol("symbol").alias("symbol"),
        F.col("datetime").alias("news_ts"),
        utc_date(raw, "datetime").alias("date_key"),
        F.coalesce(F.col("url"), F.col("headline")).alias("_story"),
        col_or_null(raw, "headline").alias("headline"),
        col_or_null(raw, "summary").alias("summary"),
        col_or_null(raw, "source").alias("source"),
        col_or_null(raw, "category").alias("category"),
        col_or_null(raw, "url").alias("url"),
        col_or_null(raw, "image").alias("image"),
        F.col("_loaded_at"),
        *[F.col(c) for c in tiebreak],
    )
    latest = dedup_latest(base, ["symbol", "news_ts", "_story"], ["_loaded_at", *tiebreak])
    return latest.select(
        "symbol", "news_ts", "date_key",
        "headline", "summary", "source", "category", "url", "image", "_loaded_at",
    )


def sector_alias_map(seed: DataFrame) -> DataFrame:
    """T-8: each seed symbol under its own, dashed and dotted spelling."""
    s = seed.select(normalize_symbol("symbol").alias("symbol"), "sector")
    keys = F.array_distinct(F.array(
        F.col("symbol"), F.replace("symbol", F.lit("."), F.lit("-")), F.replace("symbol", F.lit("-"), F.lit(".")),
    ))
    return s.select(F.explode(keys).alias("symbol_key"), "sector").distinct()


def stg_company_profiles(raw: DataFrame, seed: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """T-10: newest profile per symbol; sector from the seed aliases, else
    from the ordered industry classifier (T-9)."""
    base = raw.where(F.col("symbol").isNotNull()).withColumn("symbol", normalize_symbol("symbol"))
    latest = dedup_latest(base, ["symbol"], ["_loaded_at", *tiebreak])
    aliases = sector_alias_map(seed)
    joined = latest.join(aliases, latest["symbol"] == aliases["symbol_key"], "left")
    return joined.select(
        latest["symbol"],
        "company_name",
        F.coalesce(aliases["sector"], classify_sector("industry")).alias("sector"),
        "industry",
        "country",
        F.col("market_cap").cast("double").alias("market_cap"),
        F.col("ipo_date").try_cast("date").alias("ipo_date"),
        "logo_url",
        "web_url",
        "exchange",
        "_loaded_at",
    )
