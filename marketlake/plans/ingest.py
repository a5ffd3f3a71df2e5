"""The ingest jobs over landed responses: read, flatten, choose the provider, write raw.

backfill  a year of candles, by trading day; profiles and financials
daily     seven days of candles, as one object of the run day
news      seven days of news, as one object of the run's ISO week
monthly   profiles and financials, of the run's month
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.columns import ntz_lit
from marketlake.sources import payloads, providers, raw, writers
from marketlake.sources.landing import denied_symbols, read_payloads
from marketlake.sources.universe import filter_universe, symbol_order

MODES = ("backfill", "daily", "news", "monthly")
SWITCHES = ("symbol", "later")
BARS = "array<struct<Date: date, Open: double, High: double, Low: double, Close: double, Volume: double>>"


def _fallback_bars(landed: DataFrame) -> DataFrame:
    """The second provider's files: a JSON list of flat daily bars."""
    bars = landed.select("symbol", F.inline(F.from_json("payload", BARS)))
    return bars.where(F.col("Date").isNotNull())


def _candles(spark: SparkSession, landing: str, loaded, provider: str, symbols, seed, order) -> tuple[DataFrame, DataFrame]:
    landed = filter_universe(read_payloads(spark, f"{landing}/candles"), symbols, seed)
    primary, rejects = payloads.flatten_candles(landed, loaded)
    bars = filter_universe(read_payloads(spark, f"{landing}/fallback_candles"), symbols, seed)
    fallback = (providers.normalize_fallback_candles(_fallback_bars(bars), loaded).drop("provider_ticker")
                .withColumn("volume", F.col("volume").cast("double")))
    return providers.provider_fallback(primary, fallback, denied_symbols(landed), mode=provider, order=order), rejects.withColumn("table", F.lit("candles"))


def run_ingest(spark: SparkSession, landing: str, raw_root: str, mode: str, as_of: dt.date, loaded_at: dt.datetime,
               provider: str = "auto", symbols=None, seed: DataFrame | None = None, switch: str = "symbol",
               order: DataFrame | None = None) -> DataFrame:
    """Run one job for the symbols of ``seed`` (or the list, or the shipped
    universe) and return its rejects: (table, symbol, payload, reason).

    A denied candle response makes ``provider="auto"`` take the second provider
    for that symbol (``switch="symbol"``) or for it and every later one
    (``switch="later"``), by ``order`` (symbol, place) or the list's order."""
    if mode not in MODES:
        raise ValueError(f"ingest mode must be one of {MODES}")
    if switch not in SWITCHES:
        raise ValueError(f"provider switch must be one of {SWITCHES}")
    if switch == "later" and order is None:
        if seed is not None:
            raise ValueError("a seed has no order of symbols: pass one")
        order = symbol_order(spark, symbols)
    loaded = ntz_lit(loaded_at)
    rejects = []

    def landed(folder: str) -> DataFrame:
        return filter_universe(read_payloads(spark, f"{landing}/{folder}"), symbols, seed)

    if mode in ("backfill", "daily"):
        candles, bad = _candles(spark, landing, loaded, provider, symbols, seed, order if switch == "later" else None)
        candles = raw.ingest_window(candles, as_of, mode)
        if mode == "backfill":
            writers.write_raw_partitioned(candles, raw_root, "candles")
        else:
            writers.write_raw_period(candles, raw_root, "candles", as_of, "day")
        rejects.append(bad)
    if mode == "news":
        got = landed("news")
        news = payloads.flatten_news(got, loaded)
        writers.write_raw_period(news, raw_root, "company_news", as_of, "week")
        rejects.append(payloads.rejected(got, "company_news"))
    if mode in ("backfill", "monthly"):
        got = landed("profiles")
        writers.write_raw_period(payloads.flatten_profiles(got, loaded), raw_root, "company_profiles", as_of, "month")
        rejects.append(payloads.rejected(got, "company_profiles"))
        got = landed("financials")
        writers.write_raw_period(payloads.flatten_financials(got, loaded), raw_root, "company_financials", as_of, "month")
        rejects.append(payloads.rejected(got, "company_financials"))
    out = rejects[0].select("table", "symbol", "payload", "reason")
    for r in rejects[1:]:
        out = out.unionByName(r.select("table", "symbol", "payload", "reason"))
    return out
