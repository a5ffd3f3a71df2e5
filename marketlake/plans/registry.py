"""Query registry: key -> (Spark query, DuckDB oracle SQL).

Every Spark query takes ``(spark, sf_dir)``, reads whole driver tables
through the fixture views, and returns a DataFrame whose doubles are rounded
to 9 places so it can be compared with the oracle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators import incremental as INC
from marketlake.operators import layout as LAY
from marketlake.operators import marts, metrics, staging, timeseries, versions
from marketlake.operators.snapshot import PROFILE_CHECK_COLS, read_snapshot, run_snapshot
from marketlake.plans import fixtures as fx
from marketlake.plans import oracle as O
from marketlake.plans.build import build_price_star, build_warehouse, run_warehouse_tests
from marketlake.session import ensure_conf, scratch_path
from marketlake.sources import payloads as PL
from marketlake.sources import providers as PR
from marketlake.sources import quarantine as QU
from marketlake.sources import raw as RAW
from marketlake.sources import writers as WR
from marketlake.sources.universe import filter_universe

# Injected clocks (the reference reads current_date()).
AS_OF = dt.date(2025, 1, 15)
AS_OF_S = AS_OF.isoformat()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def finish(df: DataFrame, exact=()) -> DataFrame:
    """Round doubles to 9 places and fold -0.0 (comparison hygiene only);
    columns in ``exact`` were already rounded to significant digits."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType) and f.name not in exact:
            c = (F.round(c, 9) + F.lit(0.0)).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def sig10(c):
    """Round to 10 significant digits (compounded returns can reach 1e6+,
    where a fixed number of decimals no longer hides summation order)."""
    inv = F.pow(F.lit(10.0), F.lit(9) - F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c * inv) / inv)


def sig10_sql(c: str) -> str:
    inv = f"pow(10.0, 9 - floor(log10(abs({c}))))"
    return f"(case when {c} = 0 then 0.0 else round({c} * {inv}) / {inv} end)"


def register(key: str, sql: str | None, exact=()):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)
            return finish(fn(spark, sf_dir), exact)
        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# --- shared builders --------------------------------------------------------
def star(spark, sf_dir):
    return build_price_star(fx.fx_candles(spark, sf_dir), fx.fx_sector_map(spark, sf_dir),
                            fx.fx_profiles(spark, sf_dir))


def stg(spark, sf_dir):
    return staging.stg_candles(fx.fx_candles(spark, sf_dir), tiebreak=["event_id"])


FACT_DOUBLES = ("open", "high", "low", "close", "daily_return", "log_return", "cumulative_return",
                "volume_sma_20", "volume_zscore")


# --- staging -----------------------------------------------------------------
@register("stg_candles", O.build("select * from stg_candles", round_cols=("open", "high", "low", "close")))
def q_stg_candles(spark, sf_dir):
    """T-4 staged candles."""
    return stg(spark, sf_dir)


# --- windows -----------------------------------------------------------------
@register("lag_close", O.build(
    "select symbol, date_key, close, lag(close) over (partition by symbol order by date_key) as prev_close "
    "from stg_candles", round_cols=("close", "prev_close")))
def q_lag_close(spark, sf_dir):
    """W-1 previous available close."""
    return timeseries.with_prev_close(stg(spark, sf_dir)).select("symbol", "date_key", "close", "prev_close")


@register("daily_returns", O.build("select * from int_daily_returns",
                                   round_cols=("open", "high", "low", "close", "daily_return", "log_return")))
def q_daily_returns(spark, sf_dir):
    """W-2 simple and log returns."""
    return timeseries.daily_returns(stg(spark, sf_dir))


@register("volume_sma_20", O.build("select symbol, date_key, volume, volume_sma_20 from int_volume_stats",
                                   round_cols=("volume_sma_20",)))
def q_volume_sma_20(spark, sf_dir):
    """W-3 20-row moving average of volume."""
    return timeseries.volume_stats(stg(spark, sf_dir)).select("symbol", "date_key", "volume", "volume_sma_20")


@register("volume_stddev_20", O.build("select symbol, date_key, volume, volume_stddev_20 from int_volume_stats",
                                      round_cols=("volume_stddev_20",)))
def q_volume_stddev_20(spark, sf_dir):
    """W-4 20-row population standard deviation of volume."""
    return timeseries.volume_stats(stg(spark, sf_dir)).select("symbol", "date_key", "volume", "volume_stddev_20")


@register("volume_zscore", O.build("select symbol, date_key, volume_sma_20, volume_zscore from int_volume_stats",
                                   round_cols=("volume_sma_20", "volume_zscore")))
def q_volume_zscore(spark, sf_dir):
    """W-5 volume z-score (int_volume_stats output)."""
    return timeseries.volume_stats(stg(spark, sf_dir)).select("symbol", "date_key", "volume_sma_20", "volume_zscore")


@register("cumulative_return", O.build(
    "select symbol, date_key, log_return, exp(sum(coalesce(log_return, 0.0)) over (partition by symbol "
    "order by date_key rows between unbounded preceding and current row)) - 1 as cumulative_return "
    "from int_daily_returns", round_cols=("log_return", "cumulative_return")))
def q_cumulative_return(spark, sf_dir):
    """W-6 compounded return per symbol."""
    r = timeseries.daily_returns(stg(spark, sf_dir))
    return r.select("symbol", "date_key", "log_return",
                    timeseries.cumulative("log_return").alias("cumulative_return"))


@register("sector_cumulative_return", O.build(
    "select date_key, sector, avg_log_return, exp(sum(coalesce(avg_log_return, 0.0)) over (partition by sector "
    "order by date_key rows between unbounded preceding and current row)) - 1 as cumulative_return "
    "from sector_daily", round_cols=("avg_log_return", "cumulative_return")))
def q_sector_cumulative_return(spark, sf_dir):
    """W-7 compounded return of the sector daily means."""
    s = metrics.sector_cumulative_return(metrics.sector_daily(star(spark, sf_dir).fct_daily_prices))
    return s.select("date_key", "sector", "avg_log_return", "cumulative_return")


# --- marts -------------------------------------------------------------------
@register("dim_companies", O.build("select * from dim_companies", round_cols=("market_cap",)))
def q_dim_companies(spark, sf_dir):
    """M-1 seed-driven company dimension."""
    return star(spark, sf_dir).dim_companies


@register("fct_daily_prices", O.build("select * from fct_daily_prices", round_cols=FACT_DOUBLES))
def q_fct_daily_prices(spark, sf_dir):
    """M-7 daily price fact."""
    return star(spark, sf_dir).fct_daily_prices


# --- metrics -----------------------------------------------------------------
@register("sector_daily", O.build("select * from sector_daily", round_cols=("avg_daily_return", "avg_log_return")))
def q_sector_daily(spark, sf_dir):
    """A-1 equal-weighted sector means per day."""
    return metrics.sector_daily(star(spark, sf_dir).fct_daily_prices)


@register("sector_performance", O.build(
    "select * from sector_performance",
    round_cols=("avg_daily_return", "avg_daily_return_pct", "cumulative_return", "cumulative_return_pct")))
def q_sector_performance(spark, sf_dir):
    """A-2 sector performance (flagship)."""
    return metrics.sector_performance(star(spark, sf_dir).fct_daily_prices)


@register("sector_volatility", O.build(
    O.sector_volatility_sql(AS_OF_S),
    round_cols=("annualized_return", "annualized_volatility", "return_risk_ratio")))
def q_sector_volatility(spark, sf_dir):
    """A-3 annualised sector return and volatility over 12 months."""
    return metrics.sector_volatility(star(spark, sf_dir).fct_daily_prices, AS_OF)


# --- more staging ---------------------------------------------------------------
@register("normalize_symbol", O.build("select event_id, upper(trim(symbol)) as symbol_norm from fx_candles"))
def q_normalize_symbol(spark, sf_dir):
    """T-1 upper(trim(symbol)), Unicode-aware."""
    from marketlake.functions import normalize_symbol
    return fx.fx_candles(spark, sf_dir).select("event_id", normalize_symbol("symbol").alias("symbol_norm"))


@register("canonical_share_class", O.build(
    "select event_id, case when upper(trim(symbol))='BRK-B' then 'BRK.B' else upper(trim(symbol)) end "
    "as symbol_canonical from fx_financials"))
def q_canonical_share_class(spark, sf_dir):
    """T-2 dashed share class -> dotted seed spelling."""
    from marketlake.functions import canonical_share_class
    return fx.fx_financials(spark, sf_dir).select("event_id", canonical_share_class("symbol").alias("symbol_canonical"))


@register("dedup_latest", O.build(
    "select event_id, symbol_norm, trading_date, close, volume, _loaded_at from ("
    "select event_id, upper(trim(symbol)) as symbol_norm, trading_date, close, volume, _loaded_at, "
    "row_number() over (partition by upper(trim(symbol)), trading_date order by _loaded_at desc nulls last, "
    "event_id desc nulls last) as rn from fx_candles) t where rn = 1", round_cols=("close", "volume")))
def q_dedup_latest(spark, sf_dir):
    """T-3 newest row per key (map-side partial max)."""
    from marketlake.functions import normalize_symbol
    from marketlake.operators.dedup import dedup_latest
    c = fx.fx_candles(spark, sf_dir).select(
        "event_id", normalize_symbol("symbol").alias("symbol_norm"), "trading_date", "close", "volume", "_loaded_at")
    return dedup_latest(c, ["symbol_norm", "trading_date"], ["_loaded_at", "event_id"])


@register("json_field_coalesce", O.build(
    'select event_id, cast(coalesce("52_week_high", week_52_high) as double) as week_52_high, '
    'cast(coalesce("52_week_low", week_52_low) as double) as week_52_low from fx_financials',
    round_cols=("week_52_high", "week_52_low")))
def q_json_field_coalesce(spark, sf_dir):
    """T-5 first non-NULL of the legacy and current 52-week columns."""
    f = fx.fx_financials(spark, sf_dir)
    return f.select("event_id", staging.week52_coalesce(f, staging.WEEK52_HIGH_NAMES).alias("week_52_high"),
                    staging.week52_coalesce(f, staging.WEEK52_LOW_NAMES).alias("week_52_low"))


FIN_DOUBLES = ("pe_ratio", "pb_ratio", "eps_ttm", "dividend_yield", "beta", "week_52_high", "week_52_low",
               "market_cap")


def stg_fin(spark, sf_dir):
    return staging.stg_company_financials(fx.fx_financials(spark, sf_dir), tiebreak=["event_id"])


def stg_news(spark, sf_dir):
    return staging.stg_company_news(fx.fx_news(spark, sf_dir), tiebreak=["event_id"])


def stg_profiles(spark, sf_dir):
    return staging.stg_company_profiles(fx.fx_profiles(spark, sf_dir), fx.fx_sector_map(spark, sf_dir))


@register("stg_company_financials", O.build("select * from stg_company_financials", round_cols=FIN_DOUBLES))
def q_stg_company_financials(spark, sf_dir):
    """T-6 staged financials."""
    return stg_fin(spark, sf_dir)


@register("stg_company_news", O.build("select * from stg_company_news"))
def q_stg_company_news(spark, sf_dir):
    """T-7 staged news."""
    return stg_news(spark, sf_dir)


@register("sector_alias_map", O.build("select * from sector_map_aliases"))
def q_sector_alias_map(spark, sf_dir):
    """T-8 seed symbols under dotted and dashed spellings."""
    return staging.sector_alias_map(fx.fx_sector_map(spark, sf_dir))


@register("classify_sector", O.build(
    f"select symbol, industry, {O.CLASSIFY('industry')} as sector_rule from fx_profiles"))
def q_classify_sector(spark, sf_dir):
    """T-9 ordered first-match industry classifier."""
    from marketlake.functions import classify_sector
    return fx.fx_profiles(spark, sf_dir).select("symbol", "industry", classify_sector("industry").alias("sector_rule"))


@register("stg_company_profiles", O.build("select * from stg_company_profiles", round_cols=("market_cap",)))
def q_stg_company_profiles(spark, sf_dir):
    """T-10 staged profiles with sector."""
    return stg_profiles(spark, sf_dir)


# --- more marts ---------------------------------------------------------------------
def _dates(spark, sf_dir):
    return stg(spark, sf_dir), stg_fin(spark, sf_dir), stg_news(spark, sf_dir)


@register("date_union", O.build("select * from all_dates"))
def q_date_union(spark, sf_dir):
    """M-2 union of all staged date keys."""
    return marts.date_union(*_dates(spark, sf_dir))


@register("date_bounds", O.build(
    "select 'staged' as dates, * from date_bounds union all "
    f"select 'none', date '{AS_OF_S}' - 365, date '{AS_OF_S}'", extra={"date_bounds": O.date_bounds_sql(AS_OF_S)}))
def q_date_bounds(spark, sf_dir):
    """M-3 min/max date of the staged dates, and the defaults where there are none."""
    dates = marts.date_union(*_dates(spark, sf_dir))
    some, none = (marts.date_bounds(d, AS_OF) for d in (dates, dates.where("date_key is null")))
    return some.select(F.lit("staged").alias("dates"), "*").unionByName(none.select(F.lit("none").alias("dates"), "*"))


@register("date_spine", O.build("select * from date_spine", extra={"date_bounds": O.date_bounds_sql(AS_OF_S)}))
def q_date_spine(spark, sf_dir):
    """M-4 one row per calendar day."""
    return marts.date_spine(marts.date_bounds(marts.date_union(*_dates(spark, sf_dir)), AS_OF))


@register("trading_days", O.build("select * from trading_days"))
def q_trading_days(spark, sf_dir):
    """M-5 distinct candle dates."""
    return marts.trading_days(stg(spark, sf_dir))


_WEEKDAYS = "date_part('isodow', date_key) < 6"


@register("dim_dates", O.build(f"select * replace (is_trading and {_WEEKDAYS} as is_trading) from dim_dates",
                               extra={"date_bounds": O.date_bounds_sql(AS_OF_S)}))
def q_dim_dates(spark, sf_dir):
    """M-6 date dimension where candles trade on weekdays only."""
    candles, financials, news = _dates(spark, sf_dir)
    return marts.dim_dates(candles.where(F.weekday("date_key") < 5), financials, news, AS_OF)


@register("fct_company_financials", O.build("select * from fct_company_financials", round_cols=FIN_DOUBLES))
def q_fct_company_financials(spark, sf_dir):
    """M-8 financials fact."""
    return marts.fct_company_financials(stg_fin(spark, sf_dir))


@register("news_surrogate_key", O.build(
    "select symbol, news_ts, headline, url, news_id from fct_company_news"))
def q_news_surrogate_key(spark, sf_dir):
    """M-9 NULL-safe surrogate key of a news story."""
    return stg_news(spark, sf_dir).select("symbol", "news_ts", "headline", "url",
                                          marts.news_surrogate_key().alias("news_id"))


@register("fct_company_news", O.build("select * from fct_company_news"))
def q_fct_company_news(spark, sf_dir):
    """M-10 news fact."""
    return marts.fct_company_news(stg_news(spark, sf_dir))


# --- long-range metrics and dashboard queries ------------------------------------------
AS_OF_LONG = dt.date(1998, 6, 30)
AS_OF_LONG_S = AS_OF_LONG.isoformat()


def star_scale(spark, sf_dir):
    """Multi-year star over lineitem-derived candles (one symbol per supplier)."""
    return build_price_star(fx.fx_candles_scale(spark, sf_dir), fx.fx_sector_map_scale(spark, sf_dir),
                            fx.fx_profiles(spark, sf_dir))


@register("monthly_top_worst_sector", O.build(
    "select month_start, max(case when rb = 1 then sector end) as best_sector, "
    f"max(case when rb = 1 then {sig10_sql('monthly_return')} end) as best_return, "
    "max(case when rw = 1 then sector end) as worst_sector, "
    f"max(case when rw = 1 then {sig10_sql('monthly_return')} end) as worst_return "
    "from (select *, row_number() over (partition by month_start order by monthly_return desc, sector) as rb, "
    "row_number() over (partition by month_start order by monthly_return asc, sector) as rw "
    "from (select cast(date_trunc('month', date_key) as date) as month_start, sector, "
    "exp(sum(coalesce(avg_log_return, 0.0))) - 1 as monthly_return from sector_daily_scale group by 1, 2) m) r "
    "group by month_start"), exact=("best_return", "worst_return"))
def q_monthly_top_worst_sector(spark, sf_dir):
    """A-4 best and worst sector per month (our definition)."""
    r = metrics.monthly_top_worst_sector(star_scale(spark, sf_dir).fct_daily_prices)
    return r.withColumn("best_return", sig10(F.col("best_return"))).withColumn(
        "worst_return", sig10(F.col("worst_return")))


@register("sector_outperformance_12m", O.build(
    f"select sector, {sig10_sql('return_12m')} as return_12m, n_days, rank from ("
    "select sector, exp(sum(coalesce(avg_log_return, 0.0))) - 1 as return_12m, count(*) as n_days, "
    "row_number() over (order by exp(sum(coalesce(avg_log_return, 0.0))) - 1 desc, sector) as rank "
    f"from sector_daily_scale where date_key >= date '{AS_OF_LONG_S}' - interval 12 month "
    f"and date_key <= date '{AS_OF_LONG_S}' group by sector) q"), exact=("return_12m",))
def q_sector_outperformance_12m(spark, sf_dir):
    """Q-1 sectors ranked by 12-month compounded return."""
    r = metrics.sector_outperformance_12m(star_scale(spark, sf_dir).fct_daily_prices, AS_OF_LONG)
    return r.withColumn("return_12m", sig10(F.col("return_12m")))


@register("sector_volatility_ranking", O.build(
    "select *, row_number() over (order by annualized_volatility desc nulls last, sector) as rank from vol",
    extra={"vol": O.sector_volatility_sql(AS_OF_S)},
    round_cols=("annualized_return", "annualized_volatility", "return_risk_ratio")))
def q_sector_volatility_ranking(spark, sf_dir):
    """Q-2 sectors by annualised volatility."""
    return metrics.sector_volatility_ranking(star(spark, sf_dir).fct_daily_prices, AS_OF)


@register("sector_return_series", O.build(
    "select sector, date_key, cumulative_return_pct, avg_daily_return_pct from sector_performance",
    round_cols=("cumulative_return_pct", "avg_daily_return_pct")))
def q_sector_return_series(spark, sf_dir):
    """Q-3 cumulative return series per sector."""
    return metrics.sector_return_series(star(spark, sf_dir).fct_daily_prices)


@register("compare_financials", O.build(
    "select f.symbol, c.company_name, c.sector, f.date_key as as_of_date, f.pe_ratio, f.pb_ratio, f.eps_ttm, "
    "f.dividend_yield, f.beta, f.market_cap from (select *, row_number() over (partition by symbol "
    "order by date_key desc, _loaded_at desc) as rn from fct_company_financials) f "
    "left join dim_companies c on f.symbol = c.symbol where f.rn = 1",
    round_cols=("pe_ratio", "pb_ratio", "eps_ttm", "dividend_yield", "beta", "market_cap")))
def q_compare_financials(spark, sf_dir):
    """Q-6 latest indicators per company with sector."""
    s = star(spark, sf_dir)
    return metrics.compare_financials(marts.fct_company_financials(stg_fin(spark, sf_dir)), s.dim_companies)


# --- data quality ---------------------------------------------------------------------------
@register("check_not_null", O.build(
    "select *, concat_ws(',', case when symbol is null then 'symbol' end, case when date_key is null then "
    "'date_key' end, case when sector is null then 'sector' end, case when close is null then 'close' end, "
    "case when volume is null then 'volume' end) as failed_columns from fct_daily_prices "
    "where symbol is null or date_key is null or sector is null or close is null or volume is null",
    round_cols=FACT_DOUBLES))
def q_check_not_null(spark, sf_dir):
    """D-1 not_null over fact columns (sector is NULL for symbols missing from the seed)."""
    from marketlake.operators.quality import check_not_null
    return check_not_null(star(spark, sf_dir).fct_daily_prices, ["symbol", "date_key", "sector", "close", "volume"])


@register("check_unique", O.build(
    "select symbol as unique_field, count(*) as n_records from stg_company_financials "
    "where symbol is not null group by symbol having count(*) > 1"))
def q_check_unique(spark, sf_dir):
    """D-2 unique (failing values with counts)."""
    from marketlake.operators.quality import check_unique
    return check_unique(stg_fin(spark, sf_dir), "symbol")


@register("check_unique_combination", O.build(
    "select symbol, trading_date, count(*) as n_records from (select upper(trim(symbol)) as symbol, "
    "trading_date from fx_candles) t group by symbol, trading_date having count(*) > 1"))
def q_check_unique_combination(spark, sf_dir):
    """D-3 unique combination on raw candles (duplicate loads)."""
    from marketlake.functions import normalize_symbol
    from marketlake.operators.quality import check_unique_combination
    raw = fx.fx_candles(spark, sf_dir).select(normalize_symbol("symbol").alias("symbol"), "trading_date")
    return check_unique_combination(raw, ["symbol", "trading_date"])


@register("check_accepted_values", O.build(
    f"select sector as value_field, count(*) as n_records from stg_company_profiles "
    f"where sector is not null and sector not in ({O.ACCEPTED}) group by sector"))
def q_check_accepted_values(spark, sf_dir):
    """D-4 accepted sector names."""
    from marketlake.functions import SECTORS
    from marketlake.operators.quality import check_accepted_values
    return check_accepted_values(stg_profiles(spark, sf_dir), "sector", SECTORS)


@register("check_relationships", O.build(
    "select * from fct_daily_prices f where f.symbol is not null and not exists "
    "(select 1 from fx_sector_map s where upper(trim(s.symbol)) = f.symbol)", round_cols=FACT_DOUBLES))
def q_check_relationships(spark, sf_dir):
    """D-5 fact symbols missing from the company dimension."""
    from marketlake.operators.quality import check_relationships
    s = star(spark, sf_dir)
    return check_relationships(s.fct_daily_prices, "symbol", s.dim_companies, "symbol")


@register("check_between", O.build(
    "select * from stg_candles_long where not (close between 0 and 100000)",
    round_cols=("open", "high", "low", "close")))
def q_check_between(spark, sf_dir):
    """D-6 close within [0, 100000]."""
    from marketlake.operators.quality import check_between
    return check_between(staging.stg_candles(fx.fx_candles_long(spark, sf_dir), ["event_id"]), "close", 0, 100000)


@register("assert_positive_volume", O.build("select * from fx_candles where not volume > 0",
                                            round_cols=("open", "high", "low", "close", "volume")))
def q_assert_positive_volume(spark, sf_dir):
    """D-7 non-positive volume, on candles before staging drops such rows."""
    from marketlake.operators.quality import assert_positive_volume
    return assert_positive_volume(fx.fx_candles(spark, sf_dir))


@register("assert_valid_return_range", O.build("select * from fct_daily_prices where abs(daily_return) > 0.5",
                                               round_cols=FACT_DOUBLES))
def q_assert_valid_return_range(spark, sf_dir):
    """D-8 daily returns beyond +-50%."""
    from marketlake.operators.quality import assert_valid_return_range
    return assert_valid_return_range(star(spark, sf_dir).fct_daily_prices)


FRESH_AT = dt.datetime(2024, 2, 3, 0, 0, 0)


@register("source_freshness", O.build(
    "select max_loaded_at, age_hours, case when max_loaded_at is null then 'error' when age_hours > 96 then "
    "'error' when age_hours > 36 then 'warn' else 'pass' end as status from (select max(_loaded_at) as "
    "max_loaded_at, epoch_us(timestamp '2024-02-03 00:00:00' - max(_loaded_at)) / 3.6e9 as age_hours "
    "from fx_candles) t", round_cols=("age_hours",)))
def q_source_freshness(spark, sf_dir):
    """D-9 freshness of raw candles at an injected time."""
    from marketlake.operators.quality import source_freshness
    return source_freshness(fx.fx_candles(spark, sf_dir), FRESH_AT)


# --- column helpers -------------------------------------------------------------------------------
@register("fn_safe_divide", O.build(
    f"select event_id, {O.SAFE_DIV('close - open', 'cast(round(volume) as bigint)')} as ratio from fx_candles",
    round_cols=("ratio",)))
def q_fn_safe_divide(spark, sf_dir):
    """safe_divide: NULL on NULL or zero denominators."""
    from marketlake.functions import round_to_long, safe_divide
    c = fx.fx_candles(spark, sf_dir)
    return c.select("event_id", safe_divide(F.col("close") - F.col("open"), round_to_long("volume")).alias("ratio"))


@register("fn_cents_to_dollars", O.build(
    "select o_orderkey, round((o_orderkey * 13) / 100.0, 2) as dollars from orders", round_cols=("dollars",)))
def q_fn_cents_to_dollars(spark, sf_dir):
    """cents_to_dollars(c, 2) = round(c / 100, 2)."""
    from marketlake.functions import cents_to_dollars
    o = fx.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", cents_to_dollars(F.col("o_orderkey") * 13).alias("dollars"))


# --- sources, payloads, raw sinks -------------------------------------------------------------

def loaded_at():
    """Load stamp of the landed payloads (a fixed UTC wall-clock time)."""
    return F.to_timestamp_ntz(F.lit(fx.FIXED_LOADED_AT))
CANDLE_DOUBLES = ("open", "high", "low", "close", "volume")


def landed_candles(spark, sf_dir) -> str:
    """Write the raw candles Hive-partitioned into a fresh shared path."""
    root = scratch_path(spark, "raw")
    WR.write_raw_partitioned(fx.fx_candles(spark, sf_dir), root, "candles")
    return root


@register("scan_raw_hive", O.build(
    "select *, cast(year(trading_date) as integer) as year, cast(month(trading_date) as integer) as month, "
    "cast(day(trading_date) as integer) as day from fx_candles", round_cols=CANDLE_DOUBLES))
def q_scan_raw_hive(spark, sf_dir):
    """S-1 read Hive-partitioned raw candles with partition columns."""
    root = landed_candles(spark, sf_dir)
    return RAW.read_raw(spark, root, "candles", schema=fx.fx_candles(spark, sf_dir).schema)


@register("scan_raw_drifted", O.build(
    "select *, cast(year(trading_date) as integer) as year, cast(month(trading_date) as integer) as month, "
    "cast(day(trading_date) as integer) as day from fx_candles", round_cols=CANDLE_DOUBLES))
def q_scan_raw_drifted(spark, sf_dir):
    """S-1 raw candles of four batches whose schemas were inferred: whole
    volumes as INT64, whole volumes and prices as INT64, whole volumes as INT32,
    and the rest as DOUBLE, in one folder."""
    c = fx.fx_candles(spark, sf_dir)
    whole = F.col("volume") == F.floor("volume")
    flat = whole & (F.col("open") == F.floor("open"))
    pick = F.when(flat, "prices").when(whole & (F.col("event_id") % 3 == 0), "int").when(whole, "long").otherwise("double")
    kinds = {"prices": {x: F.col(x).cast("long") for x in ("open", "volume")}, "long": {"volume": F.col("volume").cast("long")},
             "int": {"volume": F.col("volume").cast("int")}, "double": {}}
    root, d = scratch_path(spark, "raw"), F.col("trading_date")
    for kind, cast in kinds.items():
        batch = c.where(F.coalesce(pick, F.lit("double")) == kind).withColumns(cast)
        parts = {"year": F.year(d), "month": F.lpad(F.month(d).cast("string"), 2, "0"), "day": F.lpad(F.dayofmonth(d).cast("string"), 2, "0")}
        batch.withColumns(parts).hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(f"{root}/candles")
    return RAW.read_raw(spark, root, "candles", schema=c.schema, reconcile=True)


@register("scan_seed", O.build("select symbol, sector from fx_sector_map"))
def q_scan_seed(spark, sf_dir):
    """S-2 sector seed read from CSV with a header."""
    path = scratch_path(spark, "seed")
    fx.fx_sector_map(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return RAW.read_seed(spark, path)


UNIVERSE_LIST = " u1, ,U14.b,n20 ,brk.b,,"


@register("universe_filter", O.build(
    "select 'seed' as universe, event_id, symbol from fx_candles where upper(trim(symbol)) in "
    "(select upper(trim(symbol)) from fx_sector_map) union all "
    "select 'list', event_id, symbol from fx_candles where upper(trim(symbol)) in ('U1', 'U14.B', 'N20', 'BRK.B')"))
def q_universe_filter(spark, sf_dir):
    """S-3 keep symbols of the seed universe, and of a list with blanks and any case."""
    c = fx.fx_candles(spark, sf_dir).select("event_id", "symbol")
    seeded = filter_universe(c, seed=fx.fx_sector_map(spark, sf_dir)).withColumn("universe", F.lit("seed"))
    return seeded.unionByName(filter_universe(c, UNIVERSE_LIST).withColumn("universe", F.lit("list")))


@register("flatten_candles", O.build(
    "select symbol, trading_date, open, high, low, close, volume, _loaded_at from flat_candles",
    round_cols=CANDLE_DOUBLES))
def q_flatten_candles(spark, sf_dir):
    """S-4 parallel-array candle payloads -> rows."""
    rows, _rejects = PL.flatten_candles(fx.fx_candle_payloads(spark, sf_dir), loaded_at())
    return rows


@register("flatten_profiles", O.build(
    f"select {O.SYM('c_custkey', '-')} as symbol, c_name as company_name, 'X' as exchange, "
    "c_mktsegment as industry, n_name as country, c_acctbal as market_cap, concat('L', c_custkey) as logo_url, "
    "'2001-02-03' as ipo_date, concat('W', c_custkey) as web_url, "
    f"{O.LOADED} as _loaded_at from customer join nation on c_nationkey = n_nationkey "
    "where c_custkey % 19 <> 0 and c_custkey % 23 <> 0", round_cols=("market_cap",)))
def q_flatten_profiles(spark, sf_dir):
    """S-5 profile payloads -> rows (no ticker -> skipped)."""
    return PL.flatten_profiles(fx.fx_profile_payloads(spark, sf_dir), loaded_at())


@register("flatten_news", O.build(
    f"select {O.SYM('user_id', '.')} as symbol, date_trunc('second', ts) as datetime, event_type as headline, "
    "'S' as summary, 'src' as source, 'company' as category, concat('http://x/', event_id) as url, "
    f"cast(null as varchar) as image, {O.LOADED} as _loaded_at from events "
    "where event_type not in ('error', 'signup') union all "
    f"select {O.SYM('user_id', '.')} as symbol, cast(null as timestamp) as datetime, 'h2' as headline, "
    "cast(null as varchar) as summary, 'src2' as source, 'company' as category, cast(null as varchar) as url, "
    f"cast(null as varchar) as image, {O.LOADED} as _loaded_at from events "
    "where event_type not in ('error', 'signup')"))
def q_flatten_news(spark, sf_dir):
    """S-6 news list payloads -> rows (NULL time survives)."""
    n = PL.flatten_news(fx.fx_news_payloads(spark, sf_dir), loaded_at())
    return n.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


@register("flatten_financials", O.build(
    f"select {O.SYM('user_id', '-')} as symbol, "
    "case when event_type = 'click' then null else value end as pe_ratio, "
    "case when event_type = 'click' then null else value / 2 end as pb_ratio, "
    "case when event_type = 'click' then null else value / 10 end as eps_ttm, "
    f"case when event_type = 'click' then null else cast({O.J} as double) / 100 end as dividend_yield, "
    "case when event_type = 'click' then null else 1.0::double end as beta, "
    f"case when event_type = 'click' then null else cast({O.J} as double) end as week_52_high, "
    f"case when event_type = 'click' then null else cast({O.J} as double) / 2 end as week_52_low, "
    "case when event_type = 'click' then null else value * 1000 end as market_cap, "
    f"{O.LOADED} as _loaded_at from events where event_type not in ('signup', 'view')",
    round_cols=("pe_ratio", "pb_ratio", "eps_ttm", "dividend_yield", "beta", "week_52_high", "week_52_low",
                "market_cap")))
def q_flatten_financials(spark, sf_dir):
    """S-7 metric payloads -> one row each (no metric -> NULL row)."""
    return PL.flatten_financials(fx.fx_financial_payloads(spark, sf_dir), loaded_at())


@register("normalize_fallback_candles", O.build("select * from fallback_candles",
                                                round_cols=("open", "high", "low", "close")))
def q_normalize_fallback_candles(spark, sf_dir):
    """S-8 second provider's bars in candle shape (NULL -> 0)."""
    return PR.normalize_fallback_candles(fx.fx_fallback_bars(spark, sf_dir), loaded_at())


def _rejects(df):
    return df.groupBy("symbol", "reason").agg(F.count("*").alias("n_payloads"))


def _rejects_sql(sym: str, src: str, cases: str) -> str:
    return (f"select symbol, reason, count(*) as n_payloads from (select {sym} as symbol, {cases} as reason from {src}) as judged "
            "where reason is not null group by symbol, reason")


@register("flatten_candles_rejects", O.build(_rejects_sql(O.SYM("user_id", "."), "events", (
    "case when event_type = 'error' then 'unequal array lengths' when event_type = 'signup' and event_id % 5 in (0, 1) then 'not JSON' end"))))
def q_flatten_candles_rejects(spark, sf_dir):
    """S-4 payloads that are cut off, an error page or of unequal arrays."""
    return _rejects(PL.flatten_candles(fx.fx_candle_payloads(spark, sf_dir), loaded_at())[1])


@register("flatten_profiles_rejects", O.build(_rejects_sql(O.SYM("c_custkey", "-"), "customer", (
    "case when c_custkey % 19 = 0 and c_custkey % 5 in (0, 1) then 'not JSON' end"))))
def q_flatten_profiles_rejects(spark, sf_dir):
    """S-5 payloads that are cut off or an error page."""
    return _rejects(PL.rejected(fx.fx_profile_payloads(spark, sf_dir), "company_profiles"))


@register("flatten_news_rejects", O.build(_rejects_sql(O.SYM("user_id", "."), "events", (
    "case when event_type = 'error' then 'not a list' when event_type = 'signup' and event_id % 5 in (0, 1) then 'not JSON' end"))))
def q_flatten_news_rejects(spark, sf_dir):
    """S-6 payloads that are cut off, an error page or an error object."""
    return _rejects(PL.rejected(fx.fx_news_payloads(spark, sf_dir), "company_news"))


@register("flatten_financials_rejects", O.build(_rejects_sql(O.SYM("user_id", "-"), "events", (
    "case when event_type = 'view' and event_id % 5 in (0, 1) then 'not JSON' end"))))
def q_flatten_financials_rejects(spark, sf_dir):
    """S-7 payloads that are cut off or an error page."""
    return _rejects(PL.rejected(fx.fx_financial_payloads(spark, sf_dir), "company_financials"))


_MENDED = (f"select {O.SYM('user_id', '.')} as symbol, cast(ts as date) + cast(i as integer) as trading_date, value + i as open, "
           f"value + i + 1 as high, value + i - 1 as low, case i when 0 then value else value + i - 0.5 end as close, "
           f"case i when 2 then 0.0 else cast({O.J} as double) + i end as volume, timestamp '2024-02-05 00:00:00' as _loaded_at "
           "from events, range(3) r(i) where event_type = 'error'")


@register("quarantine_replay", O.build(
    f"select symbol, trading_date, open, high, low, close, volume, _loaded_at from flat_candles union all {_MENDED}", round_cols=CANDLE_DOUBLES))
def q_quarantine_replay(spark, sf_dir):
    """S-4 raw candles after a replay: a run's rejects are kept, those with a
    short volume array are mended, land beside the run's rows and are settled;
    a second replay finds only what cannot be mended and adds nothing."""
    root = scratch_path(spark, "raw")
    rows, rejects = PL.flatten_candles(fx.fx_candle_payloads(spark, sf_dir), loaded_at())
    WR.write_raw_period(rows, root, "candles", dt.date(2024, 2, 1), "day")
    QU.quarantine(rejects.withColumn("table", F.lit("candles")), root, "2024-02-01")

    def mend(df):
        short = F.col("reason") == "unequal array lengths"
        return df.withColumn("payload", F.when(short, F.regexp_replace("payload", r'("v":\[[^\]]*)\]', "$1,0.0]")).otherwise(F.col("payload")))

    for name in ("first", "second"):
        QU.replay(spark, root, root, mend, dt.date(2024, 2, 5), dt.datetime(2024, 2, 5), name)
    return RAW.read_raw(spark, root, "candles").withColumn("_loaded_at", F.col("_loaded_at").cast("timestamp_ntz")).drop("year", "month", "day")


_GRANTED = "user_id % 3 <> 0 and user_id % 11 <> 1"
_DENIED_SYMBOLS = f"select {O.SYM('user_id', '.')} from events where user_id % 3 = 0"


@register("provider_fallback", O.build(
    "select mode, symbol, trading_date, open, high, low, close, volume, _loaded_at, provider from ("
    "select 'auto' as mode, symbol, trading_date, open, high, low, close, volume, _loaded_at, 'primary' as provider "
    f"from flat_candles where {_GRANTED} union all "
    "select 'auto', symbol, trading_date, open, high, low, close, cast(volume as double), _loaded_at, 'fallback' "
    f"from fallback_candles where symbol in ({_DENIED_SYMBOLS}) union all "
    "select 'primary', symbol, trading_date, open, high, low, close, volume, _loaded_at, 'primary' "
    f"from flat_candles where {_GRANTED} union all "
    "select 'fallback', symbol, trading_date, open, high, low, close, cast(volume as double), _loaded_at, 'fallback' "
    "from fallback_candles)", round_cols=CANDLE_DOUBLES))
def q_provider_fallback(spark, sf_dir):
    """S-9 in its three modes: a third of the symbols are denied by the
    primary and fall back; those it has no data for do not."""
    users = fx.table(spark, sf_dir, "events").select(fx.sym(F.col("user_id"), ".").alias("symbol"), (F.col("user_id") % 3 == 0).alias("denied"),
                                                      (F.col("user_id") % 11 == 1).alias("no_data")).distinct()
    with_data = fx.fx_candle_payloads(spark, sf_dir).join(users.where("not denied and not no_data"), "symbol", "left_semi")
    primary = PL.flatten_candles(with_data, loaded_at())[0].withColumn("provider", F.lit("primary"))
    fallback = (PR.normalize_fallback_candles(fx.fx_fallback_bars(spark, sf_dir), loaded_at())
                .drop("provider_ticker").withColumn("volume", F.col("volume").cast("double"))
                .withColumn("provider", F.lit("fallback")))
    modes = [PR.provider_fallback(primary, fallback, users.where("denied"), mode=m).withColumn("mode", F.lit(m)) for m in PR.PROVIDER_MODES]
    return modes[0].unionByName(modes[1]).unionByName(modes[2])


@register("provider_fallback_later", O.build(
    "select symbol, trading_date, open, high, low, close, volume, _loaded_at, 'primary' as provider from flat_candles "
    "where user_id < 37 and user_id % 11 <> 1 union all "
    "select symbol, trading_date, open, high, low, close, cast(volume as double), _loaded_at, 'fallback' "
    f"from fallback_candles where symbol in (select {O.SYM('user_id', '.')} from events where user_id >= 37)", round_cols=CANDLE_DOUBLES))
def q_provider_fallback_later(spark, sf_dir):
    """S-9 where a denial switches the provider for good: some symbols are
    denied, and the first of them in order and all later ones fall back."""
    users = fx.table(spark, sf_dir, "events").select(fx.sym(F.col("user_id"), ".").alias("symbol"), F.col("user_id").alias("place")).distinct()
    granted = users.where((F.col("place") % 50 != 37) & (F.col("place") % 11 != 1))
    primary = PL.flatten_candles(fx.fx_candle_payloads(spark, sf_dir).join(granted, "symbol", "left_semi"), loaded_at())[0].withColumn("provider", F.lit("primary"))
    fallback = (PR.normalize_fallback_candles(fx.fx_fallback_bars(spark, sf_dir), loaded_at())
                .drop("provider_ticker").withColumns({"volume": F.col("volume").cast("double"), "provider": F.lit("fallback")}))
    return PR.provider_fallback(primary, fallback, users.where(F.col("place") % 50 == 37), order=users)


@register("concat_non_empty", O.build(
    "select event_id, symbol, trading_date, open, high, low, "
    "case when day(trading_date) > 20 then null else close end as close, "
    "case when day(trading_date) between 11 and 20 then null else volume end as volume, _loaded_at "
    "from fx_candles", round_cols=CANDLE_DOUBLES))
def q_concat_non_empty(spark, sf_dir):
    """S-10 union by name of three slices with differing columns."""
    c = fx.fx_candles(spark, sf_dir)
    d = F.dayofmonth("trading_date")
    a = c.where(d <= 10)
    b = c.where(d.between(11, 20)).drop("volume")
    z = c.where(d > 20).drop("close")
    out = PR.concat_non_empty([a, None, b, z])
    return out.select(*c.columns)


AS_OF_WINDOW = dt.date(1996, 6, 30)


_WINDOW = f"date '{AS_OF_WINDOW.isoformat()}'"


@register("ingest_window", O.build(" union all ".join(
    f"select '{mode}' as mode, event_id, symbol, trading_date from fx_candles_long where trading_date between {_WINDOW} - {days} and {_WINDOW}"
    for mode, days in (("backfill", 365), ("daily", 7), ("weekly_news", 7), ("monthly", 0)))))
def q_ingest_window(spark, sf_dir):
    """S-11 the window of every job: a year, seven days, the run day."""
    c = fx.fx_candles_long(spark, sf_dir).select("event_id", "symbol", "trading_date")
    jobs = [RAW.ingest_window(c, AS_OF_WINDOW, m).withColumn("mode", F.lit(m)) for m in ("backfill", "daily", "weekly_news", "monthly")]
    return reduce(DataFrame.unionByName, jobs)


@register("write_raw_partitioned", O.build(
    "select cast(year(trading_date) as integer) as year, cast(month(trading_date) as integer) as month, "
    "cast(day(trading_date) as integer) as day, count(*) as n_rows from fx_candles group by 1, 2, 3"))
def q_write_raw_partitioned(spark, sf_dir):
    """S-12 rows per year/month/day partition after a partitioned write."""
    root = landed_candles(spark, sf_dir)
    back = RAW.read_raw(spark, root, "candles", schema=fx.fx_candles(spark, sf_dir).schema)
    return back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_rows"))


RUN_DATE = dt.date(2025, 12, 30)


@register("write_raw_period", O.build(
    "select *, cast(2026 as integer) as year, cast(1 as integer) as week from fx_news"))
def q_write_raw_period(spark, sf_dir):
    """S-13 weekly news object written twice for the same run (no duplicates;
    2025-12-30 is ISO week 1 of 2026)."""
    root = scratch_path(spark, "raw")
    news = fx.fx_news(spark, sf_dir)
    WR.write_raw_period(news, root, "company_news", RUN_DATE, "week")
    WR.write_raw_period(news, root, "company_news", RUN_DATE, "week")
    return RAW.read_raw(spark, root, "company_news", schema=news.schema)


@register("write_raw_profiles", O.build(
    "select *, cast(2024 as integer) as year, cast(2 as integer) as month from fx_profiles where symbol like '%1' "
    "union all select *, 2024, 2 from fx_profiles where symbol not like '%2'", round_cols=("market_cap",)))
def q_write_raw_profiles(spark, sf_dir):
    """S-13 two run days of one month keep an object each; a second run of a day replaces that day's."""
    root = scratch_path(spark, "raw")
    p = fx.fx_profiles(spark, sf_dir)
    WR.write_raw_period(p, root, "company_profiles", dt.date(2024, 2, 1), "month")
    WR.write_raw_period(p.where(~F.col("symbol").endswith("2")), root, "company_profiles", dt.date(2024, 2, 15), "month")
    WR.write_raw_period(p.where(F.col("symbol").endswith("1")), root, "company_profiles", dt.date(2024, 2, 1), "month")
    return RAW.read_raw(spark, root, "company_profiles", schema=p.schema)


# --- incremental loads, history, layout -------------------------------------------------------

WATERMARK_CUT = dt.date(2024, 1, 20)


def written_fact(spark, sf_dir):
    """The price fact written day-partitioned and clustered, read back."""
    fact = star(spark, sf_dir).fct_daily_prices
    path = scratch_path(spark, "fct_daily_prices")
    LAY.write_partitioned(fact, path, "date_key", cluster_cols=["symbol", "sector"])
    return LAY.read_partitioned(spark, path, fact.schema)


def written_news(spark, sf_dir):
    news = marts.fct_company_news(stg_news(spark, sf_dir))
    path = scratch_path(spark, "fct_company_news")
    LAY.write_partitioned(news, path, "date_key", cluster_cols=["symbol", "source"])
    return LAY.read_partitioned(spark, path, news.schema)


@register("watermark_filter", O.build(
    "select * from fct_daily_prices where date_key > (select coalesce(max(date_key), date '1900-01-01') "
    f"from fct_daily_prices where date_key <= date '{WATERMARK_CUT.isoformat()}')", round_cols=FACT_DOUBLES))
def q_watermark_filter(spark, sf_dir):
    """I-1 strict global watermark against an existing target (windows see
    all history; only the filter is incremental)."""
    fact = star(spark, sf_dir).fct_daily_prices
    path = scratch_path(spark, "fct_target")
    LAY.write_partitioned(fact.where(F.col("date_key") <= F.lit(WATERMARK_CUT)), path, "date_key")
    target = LAY.read_partitioned(spark, path, fact.schema)
    return INC.watermark_filter(fact, target)


UPSERT_SPLIT = dt.date(1996, 1, 1)
UPSERT_OVERLAP = dt.date(1995, 7, 1)


@register("keyed_upsert", O.build(
    f"select *, case when date_key >= date '{UPSERT_OVERLAP.isoformat()}' then 2 else 1 end as batch, "
    "cast(date_trunc('month', date_key) as date) as date_month from stg_candles_long",
    round_cols=("open", "high", "low", "close")))
def q_keyed_upsert(spark, sf_dir):
    """I-2 merge a second, overlapping batch into a month-partitioned table."""
    s = LAY.month_partition(staging.stg_candles(fx.fx_candles_long(spark, sf_dir), ["event_id"]))
    b1 = s.where(F.col("date_key") < F.lit(UPSERT_SPLIT)).withColumn("batch", F.lit(1))
    b2 = s.where(F.col("date_key") >= F.lit(UPSERT_OVERLAP)).withColumn("batch", F.lit(2))
    path = scratch_path(spark, "upsert_target")
    INC.full_refresh(b1, path, "date_month")
    INC.keyed_upsert(spark, path, b2, ["symbol", "date_key"], "date_month", b1.schema)
    return versions.read(spark, path, b1.schema)


LOOKBACK_CUT, LOOKBACK_DAYS = dt.date(2024, 1, 25), 12


@register("lookback_refresh", O.build("select * from fct_daily_prices", round_cols=FACT_DOUBLES))
def q_lookback_refresh(spark, sf_dir):
    """I-1 with a look-back: a fifth of the users' last eleven days land late,
    others are restated; the second run takes twelve days anew and equals a full
    refresh, rows that the newest load makes invalid included."""
    from marketlake.operators.price_state import refresh_prices

    raw, s = fx.fx_candles(spark, sf_dir), star(spark, sf_dir)
    day, n = F.col("trading_date"), F.col("event_id")
    recent = day > F.lit(LOOKBACK_CUT - dt.timedelta(days=LOOKBACK_DAYS - 1))
    first = raw.where((day <= F.lit(LOOKBACK_CUT)) & ~(recent & (n % 5 == 0)))
    first = first.withColumn("close", F.when(recent & (n % 7 == 0), F.lit(1.0)).otherwise(F.col("close")))
    target, state = scratch_path(spark, "lookback-fact"), scratch_path(spark, "lookback-state")
    for landed in (first, raw):
        refresh_prices(spark, None, landed, s.dim_companies, target, state, tiebreak=["event_id"], from_history=True, lookback_days=LOOKBACK_DAYS)
    return versions.read(spark, target, s.fct_daily_prices.schema)


@register("full_refresh", O.build("select * from fct_daily_prices", round_cols=FACT_DOUBLES))
def q_full_refresh(spark, sf_dir):
    """I-3 static overwrite twice: the table equals one clean build."""
    fact = star(spark, sf_dir).fct_daily_prices
    path = scratch_path(spark, "fct_full")
    INC.full_refresh(fact, path, "date_key")
    INC.full_refresh(fact, path, "date_key")
    return versions.read(spark, path, fact.schema)


RUN1 = dt.datetime(2024, 2, 1)
RUN2 = dt.datetime(2024, 3, 1)
RUN3 = dt.datetime(2024, 4, 1)
_G1 = "select * from stg_company_profiles where symbol not like '%7'"
_G2 = ("select symbol, company_name, sector, coalesce(industry, 'Filled') as industry, country, "
       "case when symbol like '%3' then market_cap + 1 else market_cap end as market_cap, ipo_date, logo_url, "
       "web_url, exchange, timestamp '2024-03-01 00:00:00' as _loaded_at from stg_company_profiles "
       "where symbol not like '%5'")
_SAME = " and ".join(f"g1.{c} is not distinct from g2.{c}" for c in O.PROFILE_COLUMNS)
_PCOLS = ["symbol", "company_name", "sector", "industry", "country", "market_cap", "ipo_date", "logo_url",
          "web_url", "exchange", "_loaded_at"]
_G1C = ", ".join(f"g1.{c}" for c in _PCOLS)
_G2C = ", ".join(f"g2.{c}" for c in _PCOLS)
_R1, _R2, _NT = "timestamp '2024-02-01 00:00:00'", "timestamp '2024-03-01 00:00:00'", "cast(null as timestamp)"


@register("scd2_snapshot", O.build(
    f"select {_G1C}, {_R1} as valid_from, {_NT} as valid_to, true as is_current from g1 left join g2 "
    f"on g1.symbol = g2.symbol where g2.symbol is null or ({_SAME}) "
    f"union all select {_G1C}, {_R1}, {_R2}, false from g1 join g2 on g1.symbol = g2.symbol where not ({_SAME}) "
    f"union all select {_G2C}, {_R2}, {_NT}, true from g2 join g1 on g1.symbol = g2.symbol where not ({_SAME}) "
    f"union all select {_G2C}, {_R2}, {_NT}, true from g2 left join g1 on g1.symbol = g2.symbol "
    "where g1.symbol is null", extra={"g1": _G1, "g2": _G2}, round_cols=("market_cap",)))
def q_scd2_snapshot(spark, sf_dir):
    """I-4 snapshot runs: changed, unchanged (only _loaded_at moved), vanished
    (stays open), new, NULL -> value; the second run is repeated, and a third
    finds nothing changed."""
    p = stg_profiles(spark, sf_dir)
    g1 = p.where(~F.col("symbol").endswith("7"))
    g2 = p.where(~F.col("symbol").endswith("5")).select(
        "symbol", "company_name", "sector", F.coalesce("industry", F.lit("Filled")).alias("industry"), "country",
        F.when(F.col("symbol").endswith("3"), F.col("market_cap") + 1).otherwise(F.col("market_cap")).alias("market_cap"),
        "ipo_date", "logo_url", "web_url", "exchange",
        F.to_timestamp_ntz(F.lit("2024-03-01 00:00:00")).alias("_loaded_at"))
    path = scratch_path(spark, "snap_company_profiles")
    for run_ts, current in ((RUN1, g1), (RUN2, g2), (RUN2, g2), (RUN3, g2)):
        run_snapshot(spark, path, current, "symbol", PROFILE_CHECK_COLS, run_ts)
    return read_snapshot(spark, path, g1.schema)


@register("partitioned_fact_write", O.build("select * from fct_daily_prices", round_cols=FACT_DOUBLES))
def q_partitioned_fact_write(spark, sf_dir):
    """I-5 day-partitioned price fact, read back."""
    return written_fact(spark, sf_dir)


@register("clustered_fact_write", O.build("select * from fct_company_news"))
def q_clustered_fact_write(spark, sf_dir):
    """I-6 news fact partitioned by day, clustered by (symbol, source)."""
    return written_news(spark, sf_dir)


Q4_START, Q4_END = dt.date(2024, 1, 10), dt.date(2024, 1, 20)


HISTORY_SYMBOLS = ("U1", "U14.B", "N20", "BRK.B", "nobody")


@register("price_history", O.build(
    f"select * from fct_daily_prices where date_key between date '{Q4_START.isoformat()}' "
    f"and date '{Q4_END.isoformat()}' and symbol in {HISTORY_SYMBOLS}", round_cols=FACT_DOUBLES))
def q_price_history(spark, sf_dir):
    """Q-4 price fact of some symbols for a date range (partition-pruned read)."""
    return metrics.price_history(written_fact(spark, sf_dir), Q4_START, Q4_END, HISTORY_SYMBOLS)


Q5_START, Q5_END = dt.date(2024, 1, 5), dt.date(2024, 1, 12)


@register("company_news_range", O.build(
    f"select * from fct_company_news where date_key between date '{Q5_START.isoformat()}' "
    f"and date '{Q5_END.isoformat()}' and symbol in {HISTORY_SYMBOLS}"))
def q_company_news_range(spark, sf_dir):
    """Q-5 news of some symbols for a period (partition-pruned read)."""
    return metrics.company_news_range(written_news(spark, sf_dir), Q5_START, Q5_END, HISTORY_SYMBOLS)


@register("price_history_by_dates", O.build(
    "select * from fct_daily_prices where symbol in ('U1', 'U14.B', 'N20', 'BRK.B', 'nobody') and "
    "date_key in (select date_key from dim_dates where is_trading and week_of_year = 3)", round_cols=FACT_DOUBLES,
    extra={"date_bounds": O.date_bounds_sql(AS_OF_S)}))
def q_price_history_by_dates(spark, sf_dir):
    """Q-4 price fact of some symbols for the trading days of an ISO week, chosen by the date dimension."""
    dates = marts.dim_dates(*_dates(spark, sf_dir), AS_OF).where("is_trading and week_of_year = 3")
    return metrics.by_dates(written_fact(spark, sf_dir), dates, HISTORY_SYMBOLS)


# --- streaming -----------------------------------------------------------------------------
STREAM_CUT = dt.date(2024, 1, 15)


@register("price_state_refresh", O.build("select * from fct_daily_prices", round_cols=FACT_DOUBLES))
def q_price_state_refresh(spark, sf_dir):
    """Price fact in three runs from the per-symbol state; the second is told
    of no landing at all and finds it by load time.  Equals one full build."""
    from marketlake.operators.price_state import refresh_prices

    raw, s = fx.fx_candles(spark, sf_dir), star(spark, sf_dir)
    target, state = scratch_path(spark, "state-fact"), scratch_path(spark, "price-state")
    for day in (dt.date(2024, 1, 8), dt.date(2024, 1, 19), dt.date(2024, 12, 31)):
        landed = raw.where(F.col("trading_date") <= F.lit(day))
        refresh_prices(spark, landed.limit(0), landed, s.dim_companies, target, state, tiebreak=["event_id"])
    return versions.read(spark, target, s.fct_daily_prices.schema)


@register("stream_price_refresh", O.build("select * from fct_daily_prices", round_cols=FACT_DOUBLES))
def q_stream_price_refresh(spark, sf_dir):
    """Incremental fact via a file-source stream: raw candles land in two
    waves (days up to the cut, then the rest); each availableNow run
    refreshes the day-partitioned fact, the second one from the per-symbol
    state (new files + 19 rows per symbol).  Equals one full build."""
    from marketlake.streaming import start_price_refresh

    raw = fx.fx_candles(spark, sf_dir)
    root = scratch_path(spark, "stream-raw")
    target = scratch_path(spark, "stream-fact")
    ckpt = scratch_path(spark, "stream-ckpt")
    state = scratch_path(spark, "stream-state")
    s = star(spark, sf_dir)
    for wave in (raw.where(F.col("trading_date") <= F.lit(STREAM_CUT)),
                 raw.where(F.col("trading_date") > F.lit(STREAM_CUT))):
        WR.write_raw_partitioned(wave, root, "candles")
        q = start_price_refresh(spark, root, raw.schema, s.dim_companies, target, ckpt, state, tiebreak=["event_id"])
        q.awaitTermination()
    return versions.read(spark, target, s.fct_daily_prices.schema)


# --- whole warehouse run ---------------------------------------------------------------------

WAREHOUSE_RUN = dt.date(2024, 1, 31)
_SUITE_SQL = O.suite_sql()


@register("warehouse_build", O.build(_SUITE_SQL, extra={"date_bounds": O.date_bounds_sql(AS_OF_S),
                                                        "sector_volatility": O.sector_volatility_sql(AS_OF_S)}))
def q_warehouse_build(spark, sf_dir):
    """Land raw candles/profiles/financials/news and the seed, run the whole
    warehouse build (incremental facts, rebuilt dimensions and metrics, SCD2
    snapshot) and return the summary of all declared data tests."""
    root = scratch_path(spark, "warehouse-raw")
    out = scratch_path(spark, "warehouse")
    seed_path = f"{root}/seed"
    fx.fx_sector_map(spark, sf_dir).write.mode("overwrite").option("header", True).csv(seed_path)
    c, p, f, n = (fx.fx_candles(spark, sf_dir), fx.fx_profiles(spark, sf_dir), fx.fx_financials(spark, sf_dir),
                  fx.fx_news(spark, sf_dir))
    WR.write_raw_partitioned(c, root, "candles")
    WR.write_raw_period(p, root, "company_profiles", WAREHOUSE_RUN, "month")
    WR.write_raw_period(f, root, "company_financials", WAREHOUSE_RUN, "month")
    WR.write_raw_period(n, root, "company_news", WAREHOUSE_RUN, "week")
    schemas = {"candles": c.schema, "company_profiles": p.schema, "company_financials": f.schema,
               "company_news": n.schema}
    models = build_warehouse(spark, root, seed_path, out, AS_OF, dt.datetime(2024, 2, 1), schemas)
    return run_warehouse_tests(models, out)
