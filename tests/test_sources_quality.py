import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators import quality as Q
from marketlake.session import scratch_path
from marketlake.sources import raw as RAW
from marketlake.sources import writers as WR
from marketlake.sources.universe import default_seed, filter_universe, parse_symbol_list
from tests.conftest import rows

CANDLE = ("symbol string, trading_date date, open double, high double, low double, close double, "
          "volume double, _loaded_at timestamp_ntz")
T = dt.datetime(2024, 1, 1)


def test_iso_week_partition_values():
    assert WR.period_values(dt.date(2025, 12, 30), "week") == {"year": "2026", "week": "01"}
    assert WR.period_values(dt.date(2024, 3, 5), "day") == {"year": "2024", "month": "03", "day": "05"}


def test_raw_partitioned_roundtrip_and_rerun(spark):
    root = scratch_path(spark, "t-raw")
    df = spark.createDataFrame([("A", dt.date(2024, 1, 5), 1.0, 1.0, 1.0, 1.0, 1.0, T),
                                ("B", dt.date(2024, 2, 5), 1.0, 1.0, 1.0, 1.0, 2.0, T)], CANDLE)
    WR.write_raw_partitioned(df, root)
    WR.write_raw_partitioned(df.where("symbol = 'A'"), root)  # re-run of one day replaces only that day
    WR.write_raw_partitioned(df.where("false"), root)  # empty run writes nothing
    back = RAW.read_raw(spark, root, "candles", schema=df.schema)
    assert rows(back, "symbol", "year", "month", "day") == [("A", 2024, 1, 5), ("B", 2024, 2, 5)]
    pruned = RAW.read_raw(spark, root, "candles", schema=df.schema, partition_filter=F.col("month") == 2)
    assert rows(pruned, "symbol") == [("B",)]


def test_period_rerun_overwrites(spark):
    root = scratch_path(spark, "t-period")
    df = spark.createDataFrame([("A", 1.0)], "symbol string, pe_ratio double")
    for _ in range(2):
        WR.write_raw_period(df, root, "company_financials", dt.date(2024, 3, 9), "month")
    back = spark.read.parquet(f"{root}/company_financials")
    assert back.count() == 1 and rows(back, "year", "month") == [(2024, 3)]


def test_ingest_windows(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i),) for i in range(400)], "trading_date date")
    as_of = dt.date(2024, 12, 31)
    assert RAW.ingest_window(df, as_of, "backfill").count() == 366
    assert RAW.ingest_window(df, as_of, "daily").count() == 8
    assert RAW.ingest_window(df, as_of, "monthly").count() == 1


def test_universe(spark):
    assert parse_symbol_list(" aapl, ,msft ,") == ["aapl", "msft"]
    seed = rows(default_seed(spark))
    assert sorted(parse_symbol_list("  ")) == [s for s, _ in seed] and len({s for s, _ in seed}) == 50 and len({x for _, x in seed}) == 11
    df = spark.createDataFrame([(" aapl ",), ("ZZZ",), ("brk.b",)], "symbol string")
    assert rows(filter_universe(df)) == [(" aapl ",), ("brk.b",)]
    seed = spark.createDataFrame([("ZZZ", "X")], "symbol string, sector string")
    assert rows(filter_universe(df, seed=seed)) == [("ZZZ",)]


def test_seed_csv(spark):
    path = scratch_path(spark, "t-seed")
    spark.createDataFrame([("BRK.B", "Financials")], "symbol string, sector string").write.option("header", True).csv(path)
    assert rows(RAW.read_seed(spark, path)) == [("BRK.B", "Financials")]


def test_quality_checks(spark):
    df = spark.createDataFrame([("A", 1.0, 1, "Technology"), ("A", None, 1, "Nope"), (None, 200000.0, -1, None)],
                               "symbol string, close double, volume long, sector string")
    assert rows(Q.check_not_null(df, ["symbol", "close"]), "failed_columns") == [("close",), ("symbol",)]
    assert rows(Q.check_unique(df, "symbol")) == [("A", 2)]
    assert rows(Q.check_unique_combination(df, ["symbol", "volume"])) == [("A", 1, 2)]
    assert rows(Q.check_accepted_values(df, "sector", ["Technology"])) == [("Nope", 1)]
    assert Q.check_between(df, "close", 0, 100000).count() == 1
    assert Q.assert_positive_volume(df).count() == 1
    parent = spark.createDataFrame([("B",)], "symbol string")
    assert Q.check_relationships(df, "symbol", parent, "symbol").count() == 2


def test_freshness_levels(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "_loaded_at timestamp_ntz")
    for hours, status in [(10, "pass"), (40, "warn"), (100, "error")]:
        r = Q.source_freshness(df, dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)).first()
        assert r.status == status and abs(r.age_hours - hours) < 1e-9
    empty = spark.createDataFrame([], "_loaded_at timestamp_ntz")
    assert Q.source_freshness(empty, dt.datetime(2024, 1, 1)).first().status == "error"


def test_quality_suite_counts(spark):
    from marketlake.operators.suite import run_quality_suite
    comp = spark.createDataFrame([("A", "Technology"), ("B", "Nope"), ("B", "Nope")], "symbol string, sector string")
    fact = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 1, 0.1), ("C", dt.date(2024, 1, 1), -1.0, 0, 0.9)],
                                 "symbol string, date_key date, close double, volume long, daily_return double")
    out = {(r.model, r.test, r.column_name): (r.failures, r.status)
           for r in run_quality_suite({"dim_companies": comp, "fct_daily_prices": fact}).collect()}
    assert out[("dim_companies", "unique", "symbol")] == (1, "fail")
    assert out[("dim_companies", "accepted_values", "sector")] == (1, "fail")
    assert out[("dim_companies", "not_null", "symbol")] == (0, "pass")
    assert out[("fct_daily_prices", "relationships", "symbol")] == (1, "fail")
    assert out[("fct_daily_prices", "between", "close")] == (1, "fail")
    assert out[("fct_daily_prices", "assert_positive_volume", "volume")] == (1, "fail")
    assert out[("fct_daily_prices", "assert_valid_return_range", "daily_return")] == (1, "fail")
    assert ("fct_daily_prices", "relationships", "date_key") not in out  # dim_dates not given


def test_landing_conforms_numeric_drift(spark):
    root = scratch_path(spark, "t-drift")
    ints = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 10, T)],
                                 "symbol string, trading_date date, open double, high double, low double, "
                                 "close double, volume long, _loaded_at timestamp_ntz")
    dbls = spark.createDataFrame([("B", dt.date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 2.5, T)], CANDLE)
    WR.write_raw_partitioned(ints, root)
    WR.write_raw_partitioned(dbls, root)
    back = RAW.read_raw(spark, root, "candles", schema=dbls.schema)
    assert rows(back, "symbol", "volume") == [("A", 10.0), ("B", 2.5)]


def test_missing_raw_table_reads_empty(spark):
    import pytest
    root = scratch_path(spark, "t-missing")
    empty = RAW.read_raw(spark, root, "company_financials", missing_ok=True)
    assert empty.count() == 0 and "week_52_high" in empty.columns and "year" in empty.columns
    with pytest.raises(Exception):
        RAW.read_raw(spark, root, "company_financials")


def test_period_landing_conforms_market_cap(spark):
    root = scratch_path(spark, "t-drift-prof")
    ints = spark.createDataFrame([("A", 10)], "symbol string, market_cap long")
    dbls = spark.createDataFrame([("B", 2.5)], "symbol string, market_cap double")
    WR.write_raw_period(ints, root, "company_profiles", dt.date(2024, 1, 31), "month")
    WR.write_raw_period(dbls, root, "company_profiles", dt.date(2024, 2, 29), "month")
    back = spark.read.parquet(f"{root}/company_profiles")
    assert dict(back.dtypes)["market_cap"] == "double"
    assert rows(back, "symbol", "market_cap") == [("A", 10.0), ("B", 2.5)]
