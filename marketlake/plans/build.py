"""End-to-end builds: raw tables -> staging -> marts -> metrics -> tests."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from marketlake.operators import (
    incremental, layout, marts, metrics, price_state, snapshot, staging, suite, timeseries, versions,
)
from marketlake.sources.raw import read_raw, read_seed


@dataclass
class Star:
    """The star schema built from one set of raw inputs."""

    stg_candles: DataFrame
    dim_companies: DataFrame
    fct_daily_prices: DataFrame


def build_price_star(raw_candles: DataFrame, seed: DataFrame, raw_profiles: DataFrame,
                     candle_tiebreak=("event_id",)) -> Star:
    stg = staging.stg_candles(raw_candles, tiebreak=[c for c in candle_tiebreak if c in raw_candles.columns])
    profiles = staging.stg_company_profiles(raw_profiles, seed)
    companies = marts.dim_companies(seed, profiles)
    fact = marts.fct_daily_prices(stg, companies)
    return Star(stg, companies, fact)


# --- full warehouse run: raw tables -> staging -> marts -> metrics -> tests ---------------


#: Models that stay views; every other one is a table under the warehouse's root.
VIEWS = ("int_daily_returns", "int_volume_stats")


def _materialize(spark, df: DataFrame, out_root: str, model: str) -> DataFrame:
    """Full rebuild of a table (staging, dimension, metric), its row tests
    counted on the way, and read it back."""
    path = f"{out_root}/{model}"
    versions.publish(df, path, counts=suite.row_counts(model))
    return versions.read(spark, path, df.schema)


def build_warehouse(spark, raw_root: str, seed_path: str, out_root: str, as_of: dt.date,
                    run_ts: dt.datetime, schemas: dict | None = None, tiebreak=("event_id",),
                    news_enabled: bool = True, new_candles: DataFrame | None = None,
                    full_refresh: bool = False, reconcile: bool = False, lookback_days: int = 0) -> dict[str, DataFrame]:
    """One warehouse run (model build in dependency order), returning every
    model by name.

    Staging tables are written once and read by every model over them;
    intermediate models stay lazy views; dimensions and metrics are rebuilt;
    every table's row tests are counted by the write that makes it; the three facts are incremental (strict watermark + keyed
    upsert into day/month partitions); company profiles get a type-2
    snapshot.  Run it again on new raw files for an incremental refresh.

    ``new_candles`` (raw candle loads of this run) switches the price fact to
    the per-symbol state refresh: windows continue from 19 rows per symbol
    instead of every symbol's full history, with the same output; loads that
    landed since the last run and are not among them are found by their load
    time.  Without it every run recomputes the windows over history.  Either
    way the run writes the state.

    ``full_refresh`` rebuilds the three facts from scratch (no watermark: late
    and restated rows are picked up).  ``reconcile`` reads raw files whose
    numeric types drifted.  ``lookback_days`` takes that many days before each
    fact's watermark anew, late and restated rows included.
    """
    schemas = schemas or {}

    def raw(table):
        return read_raw(spark, raw_root, table, schema=schemas.get(table), missing_ok=True, reconcile=reconcile)

    def tb(df):
        return [c for c in tiebreak if c in df.columns]

    seed = read_seed(spark, seed_path)
    raw_c, raw_p, raw_f = raw("candles"), raw("company_profiles"), raw("company_financials")
    stg_c = _materialize(spark, staging.stg_candles(raw_c, tiebreak=tb(raw_c)), out_root, "stg_candles")
    stg_p = _materialize(spark, staging.stg_company_profiles(raw_p, seed, tiebreak=tb(raw_p)), out_root, "stg_company_profiles")
    stg_f = _materialize(spark, staging.stg_company_financials(raw_f, tiebreak=tb(raw_f)), out_root, "stg_company_financials")
    stg_n = None
    if news_enabled:
        raw_n = raw("company_news")
        stg_n = _materialize(spark, staging.stg_company_news(raw_n, tiebreak=tb(raw_n)), out_root, "stg_company_news")

    out: dict[str, DataFrame] = {
        "stg_candles": stg_c, "stg_company_profiles": stg_p, "stg_company_financials": stg_f,
        "int_daily_returns": timeseries.daily_returns(stg_c), "int_volume_stats": timeseries.volume_stats(stg_c),
    }
    if stg_n is not None:
        out["stg_company_news"] = stg_n
    comp = _materialize(spark, marts.dim_companies(seed, stg_p), out_root, "dim_companies")
    out["dim_companies"] = comp
    out["dim_dates"] = _materialize(spark, marts.dim_dates(stg_c, stg_f, stg_n, as_of), out_root, "dim_dates")

    fact = marts.fct_daily_prices(stg_c, comp)
    fact_path = f"{out_root}/fct_daily_prices"
    state_path = f"{out_root}/_price_state"

    def refresh(df, model, keys, partition_col, watermark_col=None):
        path, counts = f"{out_root}/{model}", suite.row_counts(model)
        if full_refresh:
            incremental.full_refresh(df, path, partition_col, counts=counts)
        else:
            incremental.incremental_refresh(spark, path, df, keys, partition_col, df.schema,
                                            watermark_col=watermark_col, lookback_days=lookback_days, counts=counts)
        return versions.read(spark, path, df.schema)

    price_state.refresh_prices(spark, new_candles, raw_c, comp, fact_path, state_path, tiebreak=tb(raw_c),
                               from_history=new_candles is None, rebuild=full_refresh, staged=stg_c,
                               lookback_days=lookback_days, counts=suite.row_counts("fct_daily_prices"))
    out["fct_daily_prices"] = versions.read(spark, fact_path, fact.schema)

    fin = layout.month_partition(marts.fct_company_financials(stg_f))
    out["fct_company_financials"] = refresh(fin, "fct_company_financials", ["symbol", "date_key"], "date_month",
                                            "date_key").drop("date_month")
    if stg_n is not None:
        news = marts.fct_company_news(stg_n)
        out["fct_company_news"] = refresh(news, "fct_company_news", ["news_id"], "date_key")

    prices = out["fct_daily_prices"]
    out["sector_performance"] = _materialize(spark, metrics.sector_performance(prices), out_root, "sector_performance")
    out["sector_volatility"] = _materialize(spark, metrics.sector_volatility(prices, as_of), out_root, "sector_volatility")

    snap_path = f"{out_root}/snap_company_profiles"
    snapshot.run_snapshot(spark, snap_path, stg_p, "symbol", snapshot.PROFILE_CHECK_COLS, run_ts)
    out["snap_company_profiles"] = snapshot.read_snapshot(spark, snap_path, stg_p.schema)
    return out


def run_warehouse_tests(models: dict[str, DataFrame], out_root: str | None = None) -> DataFrame:
    """Every declared data test over the built models.  With the warehouse's
    root, row tests of its tables come from the counts of the writes."""
    written = {} if out_root is None else {m: f"{out_root}/{m}" for m in models if m not in VIEWS}
    return suite.run_quality_suite(models, written=written)
