import datetime as dt

from marketlake.operators import staging
from marketlake.operators.dedup import dedup_latest
from tests.conftest import rows

D1, D2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
T1, T2 = dt.datetime(2024, 1, 2, 1), dt.datetime(2024, 1, 2, 2)
CANDLE = ("symbol string, trading_date date, open double, high double, low double, close double, "
          "volume double, _loaded_at timestamp_ntz")


def candles(spark, data):
    return spark.createDataFrame(data, CANDLE)


def test_newest_load_invalid_drops_key(spark):
    df = candles(spark, [("AAA", D1, 1.0, 1.0, 1.0, 10.0, 5.0, T1), ("AAA", D1, 1.0, 1.0, 1.0, None, 5.0, T2),
                         ("BBB", D1, 1.0, 1.0, 1.0, 10.0, 5.0, T1)])
    assert rows(staging.stg_candles(df), "symbol") == [("BBB",)]


def test_volume_rounding(spark):
    df = candles(spark, [("A", D1, 1.0, 1.0, 1.0, 1.0, 0.4, T1), ("B", D1, 1.0, 1.0, 1.0, 1.0, 0.5, T1),
                         ("C", D1, 1.0, 1.0, 1.0, 1.0, 2.5, T1)])
    assert rows(staging.stg_candles(df), "symbol", "volume") == [("B", 1), ("C", 3)]


def test_dirty_symbols_collapse(spark):
    df = candles(spark, [(" aaa ", D1, 1.0, 1.0, 1.0, 1.0, 1.0, T1), ("AAA", D1, 1.0, 1.0, 1.0, 2.0, 1.0, T2),
                         (None, D1, 1.0, 1.0, 1.0, 2.0, 1.0, T2)])
    assert rows(staging.stg_candles(df), "symbol", "close") == [("AAA", 2.0)]


def test_dedup_hot_key_is_exact(spark):
    # one key holds most rows: the map-side partial max still returns the newest
    data = [("HOT", D1, float(i), T1 + dt.timedelta(seconds=i)) for i in range(5000)]
    data += [("COLD", D2, 1.0, T1)]
    df = spark.createDataFrame(data, "k string, d date, v double, ts timestamp_ntz").repartition(8)
    out = dedup_latest(df, ["k", "d"], ["ts"])
    assert rows(out, "k", "v") == [("COLD", 1.0), ("HOT", 4999.0)]


def test_dedup_ties_broken_by_remaining_columns(spark):
    df = spark.createDataFrame([("K", 1, "a"), ("K", 1, "b")], "k string, o int, x string")
    assert rows(dedup_latest(df, ["k"], ["o"]), "x") == [("b",)]


def test_financials_missing_52_week_column(spark):
    df = spark.createDataFrame([("brk-b", 12.0, T1, 7.0)], "symbol string, pe_ratio double, _loaded_at timestamp_ntz, week_52_high double")
    out = staging.stg_company_financials(df)
    r = out.first()
    assert (r.symbol, r.week_52_high, r.week_52_low, r.date_key) == ("BRK.B", 7.0, None, D1)


def test_financials_legacy_column_preferred(spark):
    df = spark.createDataFrame([("X", T1, 1.0, 2.0)], "symbol string, _loaded_at timestamp_ntz, `52_week_high` double, week_52_high double")
    assert staging.stg_company_financials(df).first().week_52_high == 1.0


def test_news_dedup_by_url_or_headline(spark):
    schema = ("symbol string, datetime timestamp_ntz, headline string, summary string, source string, "
              "category string, url string, image string, _loaded_at timestamp_ntz")
    df = spark.createDataFrame([
        ("A", T1, "h", "old", "s", "c", None, None, T1),
        ("A", T1, "h", "new", "s", "c", None, None, T2),
        ("A", T1, "h2", "x", "s", "c", "u", None, T1),
        ("A", None, "h", "x", "s", "c", None, None, T1),
    ], schema)
    out = staging.stg_company_news(df)
    assert rows(out, "headline", "summary") == [("h", "new"), ("h2", "x")]


def test_profiles_sector_from_alias_then_classifier(spark):
    seed = spark.createDataFrame([("BRK.B", "Financials"), ("AAPL", "Technology")], "symbol string, sector string")
    raw = spark.createDataFrame([
        ("BRK-B", "Berkshire", "X", "Insurance", "US", 1.0, "L", "2001-02-03", "W", T1),
        ("AAPL", "Apple", "X", "Biotechnology", "US", 1.0, "L", "bad-date", "W", T1),
        ("ZZZ", "Zed", "X", "Utilities", "US", 1.0, "L", None, "W", T1),
    ], "symbol string, company_name string, exchange string, industry string, country string, market_cap double, "
       "logo_url string, ipo_date string, web_url string, _loaded_at timestamp_ntz")
    out = staging.stg_company_profiles(raw, seed)
    assert rows(out, "symbol", "sector", "ipo_date") == [
        ("AAPL", "Technology", None), ("BRK-B", "Financials", dt.date(2001, 2, 3)), ("ZZZ", "Financials", None)]


def test_alias_map_distinct(spark):
    seed = spark.createDataFrame([("BRK.B", "Financials"), ("AAPL", "Technology")], "symbol string, sector string")
    assert rows(staging.sector_alias_map(seed)) == [
        ("AAPL", "Technology"), ("BRK-B", "Financials"), ("BRK.B", "Financials")]
