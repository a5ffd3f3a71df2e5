import datetime as dt
import json

from pyspark.sql import functions as F

from marketlake.sources import payloads as PL
from marketlake.sources import providers as PR
from tests.conftest import rows

LOADED = dt.datetime(2024, 2, 1)
T0 = int(dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc).timestamp())


def pay(spark, items):
    return spark.createDataFrame(items, "symbol string, payload string")


def test_candles_edge_cases(spark):
    ok = json.dumps({"s": "ok", "t": [T0, T0 + 86400], "o": [1, 2], "h": [1, 2], "l": [1, 2], "c": [1, 2.5], "v": [10, 20]})
    bad = json.dumps({"s": "ok", "t": [T0], "o": [1, 2], "h": [1], "l": [1], "c": [1], "v": [1]})
    df = pay(spark, [("A", ok), ("B", json.dumps({"s": "no_data"})), ("C", None), ("D", bad), ("E", "{}")])
    good, rej = PL.flatten_candles(df, F.lit(LOADED))
    assert rows(good, "symbol", "trading_date", "close", "volume") == [
        ("A", dt.date(2024, 1, 2), 1.0, 10.0), ("A", dt.date(2024, 1, 3), 2.5, 20.0)]
    assert rows(rej, "symbol") == [("D",)]


def test_profiles_skip_missing_ticker(spark):
    df = spark.createDataFrame([(json.dumps({"ticker": "AAPL", "name": "Apple", "marketCapitalization": 3}),),
                                (json.dumps({"name": "NoTicker"}),), (json.dumps({"ticker": ""}),), (None,)],
                               "payload string")
    out = PL.flatten_profiles(df, F.lit(LOADED))
    assert rows(out, "symbol", "company_name", "market_cap") == [("AAPL", "Apple", 3.0)]


def test_news_list_only_and_null_time(spark):
    items = json.dumps([{"datetime": T0, "headline": "a"}, {"headline": "b"}])
    df = pay(spark, [("A", items), ("B", json.dumps({"error": "x"})), ("C", "[]"), ("D", None)])
    out = PL.flatten_news(df, F.lit(LOADED)).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    assert rows(out, "symbol", "headline", "datetime") == [
        ("A", "a", dt.datetime(2024, 1, 2)), ("A", "b", None)]


def test_financials_metric_rules(spark):
    full = json.dumps({"metric": {"peBasicExclExtraTTM": 20.5, "52WeekHigh": 10, "52WeekLow": 5}})
    df = pay(spark, [("A", full), ("B", json.dumps({"symbol": "B"})), ("C", "{}"), ("D", None)])
    out = PL.flatten_financials(df, F.lit(LOADED))
    assert rows(out, "symbol", "pe_ratio", "week_52_high", "week_52_low") == [
        ("A", 20.5, 10.0, 5.0), ("B", None, None, None)]


def test_fallback_fills_and_precedence(spark):
    bars = spark.createDataFrame([("BRK.B", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, None, 10.9)],
                                 "symbol string, Date date, Open double, High double, Low double, Close double, Volume double")
    fb = PR.normalize_fallback_candles(bars, F.lit(LOADED)).first()
    assert (fb.symbol, fb.provider_ticker, fb.close, fb.volume) == ("BRK.B", "BRK-B", 0.0, 10)
    prim = spark.createDataFrame([("A", 1)], "symbol string, v int")
    fall = spark.createDataFrame([("A", 2), ("B", 3)], "symbol string, v int")
    fall = fall.unionByName(spark.createDataFrame([("C", 4)], "symbol string, v int"))  # the primary has no data for C
    denied = spark.createDataFrame([(" b ",)], "symbol string")
    assert rows(PR.provider_fallback(prim, fall, denied), "symbol", "v") == [("A", 1), ("B", 3)]


def test_concat_non_empty_aligns_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y",)], "s string")
    out = PR.concat_non_empty([a, None, spark.createDataFrame([], "struct<>"), b])
    assert rows(out, "i", "s") == [(1, "x"), (None, "y")]
    assert PR.concat_non_empty([]) is None


def test_provider_modes(spark):
    import pytest
    prim = spark.createDataFrame([("A", 1)], "symbol string, v int")
    fall = spark.createDataFrame([("A", 2), ("B", 3)], "symbol string, v int")
    denied = spark.createDataFrame([("A",)], "symbol string")
    assert rows(PR.provider_fallback(prim, fall, denied, mode="primary"), "symbol", "v") == [("A", 1)]
    assert rows(PR.provider_fallback(prim, fall, denied, mode=" FALLBACK "), "symbol", "v") == [("A", 2), ("B", 3)]
    with pytest.raises(ValueError):
        PR.provider_fallback(prim, fall, denied, mode="other")


def test_broken_bodies_are_rejected_with_a_reason(spark):
    bodies = [("cut", '{"s":"ok","t":[1'), ("page", "<html>no</html>"), ("list", "[1]"), ("object", '{"error":"denied"}'), ("empty", ""), ("null", None), ("ok", "{}")]
    got = {t: {r.symbol: r.reason for r in PL.rejected(pay(spark, bodies), t).collect()} for t in PL.FORMS}
    broken = {"cut": "not JSON", "page": "not JSON", "empty": "not JSON"}
    for t in ("candles", "company_profiles", "company_financials"):
        assert got[t] == {**broken, "list": "not an object"}
    assert got["company_news"] == {**broken, "object": "not a list", "ok": "not a list"}
    for flat in (PL.flatten_candles(pay(spark, bodies), F.lit(LOADED))[0], PL.flatten_profiles(pay(spark, bodies), F.lit(LOADED)),
                 PL.flatten_news(pay(spark, bodies), F.lit(LOADED))):
        assert flat.count() == 0
    assert rows(PL.flatten_financials(pay(spark, bodies), F.lit(LOADED)), "symbol") == [("object",)]


def test_ingest_jobs(spark):
    import os

    from marketlake.plans.ingest import run_ingest
    from marketlake.session import scratch_path
    from marketlake.sources.raw import read_raw

    def land(root, folder, **bodies):
        os.makedirs(f"{root}/{folder}")
        for name, body in bodies.items():
            with open(f"{root}/{folder}/{name.replace('_', '.')}.json", "w") as f:
                f.write(body if isinstance(body, str) else json.dumps(body))

    day = dt.date(2024, 1, 10)
    at = lambda d: int(dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc).timestamp())
    bars = lambda *days: {"s": "ok", "t": [at(d) for d in days], **{c: [1.0] * len(days) for c in "ohlcv"}}
    landing, raw = (scratch_path(spark, n).removeprefix("file:") for n in ("t-land", "t-raw"))
    land(landing, "candles", AAPL=bars(1, 2, 9), MSFT={"error": "You don't have access to this resource."}, NVDA={"s": "no_data"}, META="<html>", ZZZ=bars(9))
    fallback = [{"Date": "2024-01-09", "Open": 2.0, "High": 2.0, "Low": 2.0, "Close": None, "Volume": 5.0}]
    land(landing, "fallback_candles", MSFT=fallback, NVDA=fallback, BRK_B=fallback)
    land(landing, "news", AAPL=[{"datetime": at(9), "headline": "h"}], MSFT={"error": "denied"})
    land(landing, "profiles", AAPL={"ticker": "AAPL", "name": "Apple"}, BRK_B={"ticker": "BRK-B"}, CRM={})
    land(landing, "financials", AAPL={"metric": {"beta": 1.5}}, MSFT='{"metric":')
    run = lambda mode, **more: rows(run_ingest(spark, landing, raw, mode, day, LOADED, **more), "table", "symbol", "reason")

    assert run("daily") == [("candles", "META", "not JSON")]
    got = read_raw(spark, raw, "candles")
    assert rows(got, "symbol", "trading_date", "close", "day") == [("AAPL", dt.date(2024, 1, 9), 1.0, 10), ("MSFT", dt.date(2024, 1, 9), 0.0, 10)]
    assert run("news") == [("company_news", "MSFT", "not a list")]
    assert rows(read_raw(spark, raw, "company_news"), "symbol", "headline", "week") == [("AAPL", "h", 2)]
    assert run("monthly") == [("company_financials", "MSFT", "not JSON")]
    assert rows(read_raw(spark, raw, "company_profiles"), "symbol", "company_name") == [("AAPL", "Apple"), ("BRK-B", None)]
    assert rows(read_raw(spark, raw, "company_financials"), "symbol", "beta") == [("AAPL", 1.5)]
    again = scratch_path(spark, "t-raw").removeprefix("file:")
    run_ingest(spark, landing, again, "backfill", day, LOADED, provider="primary", symbols="aapl, zzz")
    assert rows(read_raw(spark, again, "candles"), "symbol", "day") == [("AAPL", 1), ("AAPL", 2), ("AAPL", 9), ("ZZZ", 9)]
    assert run_ingest(spark, f"{landing}/none", again, "daily", day, LOADED).count() == 0


def test_profiles_of_two_run_days_stay(spark):
    from marketlake.session import scratch_path
    from marketlake.sources import writers as WR
    from marketlake.sources.raw import read_raw

    root = scratch_path(spark, "t-days")
    schema = "symbol string, company_name string"
    write = lambda d, *pairs: WR.write_raw_period(spark.createDataFrame(pairs, schema), root, "company_profiles", dt.date(2024, 2, d), "month")
    write(1, ("A", "a"), ("B", "b"))
    write(15, ("A", "a2"))
    write(15, ("A", "a3"))
    assert rows(read_raw(spark, root, "company_profiles"), "symbol", "company_name", "month") == [("A", "a", 2), ("A", "a3", 2), ("B", "b", 2)]
