"""Market-data views derived from the driver's tables.

The driver ships TPC-H-like tables and an ``events`` stream, no market data,
so these views re-shape them into raw candles, profiles, news, financials and
the sector seed (definitions in FIXTURES.md).  Every view reads a whole table;
the oracle side of each view lives in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import sf_path


#: Columns of the driver tables that the views read: with them no job has to look for a schema in the files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.schema(TABLES[name]).parquet(sf_path(sf_dir, name))


def sym(n: Column, sep: str) -> Column:
    """Symbol of a traded company: multiples of 10 are listed under names that
    the seed does not have, the others under the seed's."""
    return F.when(n % 10 == 0, F.concat(F.lit("N"), n.cast("string"))).otherwise(seed_sym(n, sep))


def seed_sym(n: Column, sep: str) -> Column:
    """Symbol for an integer id: 7 is the share-class name, multiples of 7 get
    a class suffix, the rest are plain."""
    return (
        F.when(n == 7, F.lit(f"BRK{sep}B"))
        .when(n % 7 == 0, F.concat(F.lit("U"), n.cast("string"), F.lit(f"{sep}B")))
        .otherwise(F.concat(F.lit("U"), n.cast("string")))
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def fx_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw candles: ~2.5 loads per (symbol, day), NULL closes, .5 volumes,
    zero volumes, dirty symbols (case and padding)."""
    e = table(spark, sf_dir, "events")
    s = sym(F.col("user_id"), ".")
    dirty = (F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" "), F.lower(s), F.lit(" ")))
             .when(F.col("event_id") % 3 == 1, F.lower(s)).otherwise(s))
    return e.select(
        "event_id",
        dirty.alias("symbol"),
        F.col("ts").cast("date").alias("trading_date"),
        F.col("value").alias("open"),
        (F.col("value") + 1).alias("high"),
        F.greatest(F.col("value") - 1, F.lit(0.01)).alias("low"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("close"),
        (_k().cast("double") * 0.5).alias("volume"),
        F.col("ts").alias("_loaded_at"),
    )


def fx_candles_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse multi-year candles from orders (1992-1998)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("event_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"),
        F.col("o_orderdate").cast("date").alias("trading_date"),
        F.col("o_totalprice").alias("open"),
        F.col("o_totalprice").alias("high"),
        F.col("o_totalprice").alias("low"),
        F.col("o_totalprice").alias("close"),
        (F.col("o_orderkey") % 100).cast("double").alias("volume"),
        F.col("o_orderdate").alias("_loaded_at"),
    )


def fx_candles_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark candles from lineitem: one symbol per supplier."""
    li = table(spark, sf_dir, "lineitem")
    px = F.col("l_extendedprice") / F.col("l_quantity")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").cast("date").alias("trading_date"),
        px.alias("open"),
        (px * (1 + F.col("l_tax"))).alias("high"),
        (px * (1 - F.col("l_discount"))).alias("low"),
        px.alias("close"),
        F.col("l_quantity").alias("volume"),
        F.col("l_shipdate").alias("_loaded_at"),
    )


def _region_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"])
            .join(r, n["n_regionkey"] == r["r_regionkey"]))


def fx_sector_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed: symbol -> sector (region name) of every customer."""
    j = _region_of_customer(spark, sf_dir)
    return j.select(seed_sym(F.col("c_custkey"), ".").alias("symbol"), F.col("r_name").alias("sector"))


def fx_sector_map_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed for the ``S<suppkey>`` symbols of ``fx_candles_scale``."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
                    F.col("r_name").alias("sector"))


def fx_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw profiles: dashed share classes, NULL industry, classifier quirks."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    industry = (F.when(k % 11 == 0, F.lit(None).cast("string"))
                .when(k % 13 == 0, F.lit("Biotechnology"))
                .when(k % 17 == 0, F.lit("Utilities"))
                .otherwise(F.col("c_mktsegment")))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        sym(k, "-").alias("symbol"),
        F.col("c_name").alias("company_name"),
        industry.alias("industry"),
        F.col("n_name").alias("country"),
        F.col("c_acctbal").alias("market_cap"),
        F.lit("2001-02-03").alias("ipo_date"),
        F.lit("X").alias("exchange"),
        F.concat(F.lit("L"), k.cast("string")).alias("logo_url"),
        F.concat(F.lit("W"), k.cast("string")).alias("web_url"),
        F.to_timestamp_ntz(F.lit("2024-01-31 00:00:00")).alias("_loaded_at"),
    )


def fx_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw news: hour-truncated times, duplicate stories, NULL urls."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        sym(F.col("user_id"), ".").alias("symbol"),
        # hour truncation kept zone-free (date_trunc would return a zoned timestamp)
        F.make_timestamp_ntz(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"), F.lit(0),
                             F.lit(0)).alias("datetime"),
        F.col("event_type").alias("headline"),
        F.concat(F.lit("S"), (F.col("event_id") % 7).cast("string")).alias("summary"),
        F.concat(F.lit("src"), (F.col("event_id") % 5).cast("string")).alias("source"),
        F.col("event_type").alias("category"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("http://x/"), _k())).alias("url"),
        F.lit(None).cast("string").alias("image"),
        F.col("ts").alias("_loaded_at"),
    )


def fx_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw financials; the 52-week range alternates between two column names."""
    e = table(spark, sf_dir, "events")
    kv = _k().cast("double")
    even = F.col("event_id") % 2 == 0
    return e.select(
        "event_id",
        sym(F.col("user_id"), "-").alias("symbol"),
        F.col("value").alias("pe_ratio"),
        (F.col("value") / 2).alias("pb_ratio"),
        (F.col("value") / 10).alias("eps_ttm"),
        (kv / 100).alias("dividend_yield"),
        F.lit(1.0).alias("beta"),
        F.when(even, kv).alias("52_week_high"),
        F.when(~even, kv).alias("week_52_high"),
        F.when(even, kv / 2).alias("52_week_low"),
        F.when(~even, kv / 2).alias("week_52_low"),
        (F.col("value") * 1000).alias("market_cap"),
        F.col("ts").alias("_loaded_at"),
    )


def broken(payload: Column, n: Column) -> Column:
    """Every fifth body is cut off and every fifth an error page."""
    return (F.when(n % 5 == 0, F.lit('[{"datetime": 17'))
            .when(n % 5 == 1, F.lit("<html>Bad gateway</html>")).otherwise(payload))


# --- landed payloads (JSON text per API response) ------------------------------
FIXED_LOADED_AT = "2024-02-01 00:00:00"


def epoch_of(ts: Column) -> Column:
    """Whole epoch seconds of a UTC wall-clock ``timestamp_ntz``."""
    return (F.unix_date(ts.cast("date")).cast("long") * 86400 + F.hour(ts) * 3600
            + F.minute(ts) * 60 + F.second(ts))


def fx_candle_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 3-bar candle response per event: ``signup`` -> ``no_data`` or broken,
    ``error`` -> a short volume array, every 10th purchase -> NULL."""
    e = table(spark, sf_dir, "events")
    t0 = F.unix_date(F.col("ts").cast("date")).cast("long") * 86400
    v, k = F.col("value"), _k().cast("double")
    body = F.struct(
        F.when(F.col("event_type") == "signup", F.lit("no_data")).otherwise(F.lit("ok")).alias("s"),
        F.array(t0, t0 + 86400, t0 + 172800).alias("t"),
        F.array(v, v + 1, v + 2).alias("o"),
        F.array(v + 1, v + 2, v + 3).alias("h"),
        F.array(v - 1, v, v + 1).alias("l"),
        F.array(v, v + 0.5, v + 1.5).alias("c"),
        F.when(F.col("event_type") == "error", F.array(k, k + 1)).otherwise(F.array(k, k + 1, k + 2)).alias("v"),
    )
    null_payload = (F.col("event_type") == "purchase") & (F.col("event_id") % 10 == 0)
    payload = (F.when(null_payload, F.lit(None).cast("string"))
               .when(F.col("event_type") == "signup", broken(F.to_json(body), F.col("event_id"))).otherwise(F.to_json(body)))
    return e.select(sym(F.col("user_id"), ".").alias("symbol"), payload.alias("payload"))


def fx_profile_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile object per customer; some lack a ticker or have an empty one."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    ticker = (F.when(k % 19 == 0, F.lit(None).cast("string")).when(k % 23 == 0, F.lit(""))
              .otherwise(sym(k, "-")))
    body = F.struct(
        ticker.alias("ticker"), F.col("c_name").alias("name"), F.lit("X").alias("exchange"),
        F.col("c_mktsegment").alias("finnhubIndustry"), F.col("n_name").alias("country"),
        F.col("c_acctbal").alias("marketCapitalization"), F.concat(F.lit("L"), k.cast("string")).alias("logo"),
        F.lit("2001-02-03").alias("ipo"), F.concat(F.lit("W"), k.cast("string")).alias("weburl"),
    )
    payload = F.when(k % 19 == 0, broken(F.to_json(body), k)).otherwise(F.to_json(body))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(sym(k, "-").alias("symbol"), payload.alias("payload"))


def fx_news_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 2-item news list per event (second item without a time); ``error``
    events get an error object, ``signup`` events an empty list."""
    e = table(spark, sf_dir, "events")
    item1 = F.struct(epoch_of(F.col("ts")).alias("datetime"), F.col("event_type").alias("headline"),
                     F.lit("S").alias("summary"), F.lit("src").alias("source"), F.lit("company").alias("category"),
                     F.concat(F.lit("http://x/"), F.col("event_id").cast("string")).alias("url"),
                     F.lit(None).cast("string").alias("image"))
    item2 = F.struct(F.lit(None).cast("long").alias("datetime"), F.lit("h2").alias("headline"),
                     F.lit(None).cast("string").alias("summary"), F.lit("src2").alias("source"),
                     F.lit("company").alias("category"), F.lit(None).cast("string").alias("url"),
                     F.lit(None).cast("string").alias("image"))
    payload = (F.when(F.col("event_type") == "error", F.lit('{"error":"denied"}'))
               .when(F.col("event_type") == "signup", broken(F.lit("[]"), F.col("event_id")))
               .otherwise(F.to_json(F.array(item1, item2))))
    return e.select(sym(F.col("user_id"), ".").alias("symbol"), payload.alias("payload"))


def fx_financial_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metrics response per event: NULL (signup), ``{}`` (view), without
    ``metric`` (click) or full."""
    e = table(spark, sf_dir, "events")
    v, k = F.col("value"), _k().cast("double")
    metric = F.struct(v.alias("peBasicExclExtraTTM"), (v / 2).alias("pbAnnual"), (v / 10).alias("epsTTM"),
                      (k / 100).alias("dividendYieldIndicatedAnnual"), F.lit(1.0).alias("beta"),
                      k.alias("52WeekHigh"), (k / 2).alias("52WeekLow"), (v * 1000).alias("marketCapitalization"))
    payload = (F.when(F.col("event_type") == "signup", F.lit(None).cast("string"))
               .when(F.col("event_type") == "view", broken(F.lit("{}"), F.col("event_id")))
               .when(F.col("event_type") == "click", F.lit('{"symbol":"X"}'))
               .otherwise(F.to_json(F.struct(metric.alias("metric")))))
    return e.select(sym(F.col("user_id"), "-").alias("symbol"), payload.alias("payload"))


def fx_fallback_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second provider's flat daily bars (NULL close and volume on errors)."""
    e = table(spark, sf_dir, "events")
    err = F.col("event_type") == "error"
    return e.select(
        "event_id",
        sym(F.col("user_id"), ".").alias("symbol"),
        F.col("ts").cast("date").alias("Date"),
        F.col("value").alias("Open"), (F.col("value") + 1).alias("High"),
        F.greatest(F.col("value") - 1, F.lit(0.01)).alias("Low"),
        F.when(err, F.lit(None).cast("double")).otherwise(F.col("value")).alias("Close"),
        F.when(err, F.lit(None).cast("double")).otherwise(_k().cast("double") * 0.5).alias("Volume"),
    )


def fx_candles_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_candles_scale`` where a third of all rows are loads of one symbol
    (skew check: dedup must pre-aggregate the hot key map-side)."""
    c = fx_candles_scale(spark, sf_dir)
    hot = (F.col("event_id") % 3) == 0
    return c.withColumn("symbol", F.when(hot, F.lit("HOT")).otherwise(F.col("symbol")))
