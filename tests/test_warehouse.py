import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators import versions
from marketlake.plans import fixtures as fx
from marketlake.plans import registry as R
from marketlake.plans.build import build_warehouse
from marketlake.session import scratch_path
from marketlake.sources import writers as WR

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_two_incremental_runs_equal_one_full_build(spark):
    c, p, f = fx.fx_candles(spark, SF), fx.fx_profiles(spark, SF), fx.fx_financials(spark, SF)
    schemas = {"candles": c.schema, "company_profiles": p.schema, "company_financials": f.schema}
    seed = scratch_path(spark, "t-seed")
    fx.fx_sector_map(spark, SF).write.option("header", True).csv(seed)
    as_of, cut = dt.date(2025, 1, 15), dt.date(2024, 1, 15)

    def land(root, candles):
        WR.write_raw_partitioned(candles, root, "candles")
        WR.write_raw_period(p, root, "company_profiles", dt.date(2024, 1, 31), "month")
        WR.write_raw_period(f, root, "company_financials", dt.date(2024, 1, 31), "month")

    inc_raw, inc_out = scratch_path(spark, "t-raw-inc"), scratch_path(spark, "t-wh-inc")
    land(inc_raw, c.where(F.col("trading_date") <= F.lit(cut)))
    build_warehouse(spark, inc_raw, seed, inc_out, as_of, dt.datetime(2024, 2, 1), schemas, news_enabled=False)
    land(inc_raw, c.where(F.col("trading_date") > F.lit(cut)))
    inc = build_warehouse(spark, inc_raw, seed, inc_out, as_of, dt.datetime(2024, 2, 2), schemas, news_enabled=False)

    # same two runs, prices refreshed from the per-symbol state
    st_raw, st_out = scratch_path(spark, "t-raw-st"), scratch_path(spark, "t-wh-st")
    wave1, wave2 = c.where(F.col("trading_date") <= F.lit(cut)), c.where(F.col("trading_date") > F.lit(cut))
    land(st_raw, wave1)
    build_warehouse(spark, st_raw, seed, st_out, as_of, dt.datetime(2024, 2, 1), schemas, news_enabled=False,
                    new_candles=wave1)
    land(st_raw, wave2)
    st = build_warehouse(spark, st_raw, seed, st_out, as_of, dt.datetime(2024, 2, 2), schemas, news_enabled=False,
                         new_candles=wave2)

    full_raw, full_out = scratch_path(spark, "t-raw-full"), scratch_path(spark, "t-wh-full")
    land(full_raw, c)
    full = build_warehouse(spark, full_raw, seed, full_out, as_of, dt.datetime(2024, 2, 1), schemas,
                           news_enabled=False)
    for name in ("fct_daily_prices", "sector_performance", "sector_volatility", "dim_dates"):
        for a in (inc[name], st[name]):
            b = full[name]
            assert a.count() == b.count() and a.exceptAll(b).count() == 0, name
    # snapshot ran twice without changes: still one open version per symbol
    snap = inc["snap_company_profiles"]
    assert snap.where("is_current").groupBy("symbol").count().where("count > 1").count() == 0
    assert snap.count() == full["snap_company_profiles"].count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_cli_build_and_freshness(spark, capsys):
    from marketlake.__main__ import main
    from marketlake.sources.raw import RAW_CANDLES, RAW_FINANCIALS, RAW_PROFILES

    def declared(df, schema):
        cols = []
        for fld in schema.fields:
            cols.append((F.col(f"`{fld.name}`") if fld.name in df.columns else F.lit(None))
                        .cast(fld.dataType).alias(fld.name))
        return df.select(*cols)

    root, out = scratch_path(spark, "t-cli-raw"), scratch_path(spark, "t-cli-out")
    seed = scratch_path(spark, "t-cli-seed")
    fx.fx_sector_map(spark, SF).write.option("header", True).csv(seed)
    candles = declared(fx.fx_candles(spark, SF), RAW_CANDLES)
    cut = dt.date(2024, 1, 20)
    WR.write_raw_partitioned(candles.where(F.col("trading_date") <= F.lit(cut)), root, "candles")
    WR.write_raw_period(declared(fx.fx_profiles(spark, SF), RAW_PROFILES), root, "company_profiles",
                        dt.date(2024, 1, 31), "month")
    WR.write_raw_period(declared(fx.fx_financials(spark, SF), RAW_FINANCIALS), root, "company_financials",
                        dt.date(2024, 1, 31), "month")
    code = main(["build", "--raw", root, "--seed", seed, "--out", out, "--as-of", "2025-01-15", "--no-news",
                 "--warn-only"])
    text = capsys.readouterr().out
    assert code == 0 and "passed" in text and "FAIL dim_companies.accepted_values(sector)" in text
    # daily run: new files land in the raw table and in this run's landing root
    landing = scratch_path(spark, "t-cli-landing")
    wave2 = candles.where(F.col("trading_date") > F.lit(cut))
    WR.write_raw_partitioned(wave2, root, "candles")
    WR.write_raw_partitioned(wave2, landing, "candles")
    assert main(["build", "--raw", root, "--seed", seed, "--out", out, "--as-of", "2025-01-15", "--no-news",
                 "--warn-only", "--new-raw", landing]) == 0
    capsys.readouterr()
    want = R.star(spark, SF).fct_daily_prices
    got = versions.read(spark, f"{out}/fct_daily_prices", want.schema)
    assert got.count() == want.count()
    assert main(["freshness", "--raw", root, "--as-of-ts", "2024-02-01 00:00:00"]) == 0
    assert "status=pass" in capsys.readouterr().out


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_late_symbol_ignored_until_full_refresh(spark):
    c, p, f = fx.fx_candles(spark, SF), fx.fx_profiles(spark, SF), fx.fx_financials(spark, SF)
    schemas = {"candles": c.schema, "company_profiles": p.schema, "company_financials": f.schema}
    seed = scratch_path(spark, "t-seed-late")
    fx.fx_sector_map(spark, SF).write.option("header", True).csv(seed)
    raw, out = scratch_path(spark, "t-raw-late"), scratch_path(spark, "t-wh-late")
    WR.write_raw_partitioned(c, raw, "candles")
    WR.write_raw_period(p, raw, "company_profiles", dt.date(2024, 1, 31), "month")
    WR.write_raw_period(f, raw, "company_financials", dt.date(2024, 1, 31), "month")
    args = (spark, raw, seed, out, dt.date(2025, 1, 15), dt.datetime(2024, 2, 1), schemas)
    build_warehouse(*args, news_enabled=False)
    late = (c.where(F.upper(F.trim("symbol")) == "U1").withColumn("symbol", F.lit("LATE1"))
            .withColumn("event_id", F.col("event_id") + 40_000_000))
    # a daily run lands its bars under the run day, not the trading days
    WR.write_raw_period(late, raw, "candles", dt.date(2024, 2, 5), "day")
    inc = build_warehouse(*args, news_enabled=False)
    assert inc["fct_daily_prices"].where("symbol = 'LATE1'").count() == 0
    n_before = inc["fct_daily_prices"].count()
    full = build_warehouse(*args, news_enabled=False, full_refresh=True)
    n_late = full["fct_daily_prices"].where("symbol = 'LATE1'").count()
    assert n_late > 0 and full["fct_daily_prices"].count() == n_before + n_late
