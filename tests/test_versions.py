import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators import incremental, marts, price_state, snapshot, staging, versions
from marketlake.operators.marts import FACT_PRICE_COLUMNS
from marketlake.plans import fixtures as fx
from marketlake.plans import registry as R
from marketlake.plans.build import build_warehouse
from marketlake.session import checkpoint_root, scratch_path
from marketlake.sources import writers as WR
from marketlake.sources.raw import read_raw
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
SCHEMA = "symbol string, date_key date, close double"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def d(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def local(path):
    return path.removeprefix("file:")


def spoil(path):
    """Make one data file unreadable."""
    for folder, _, names in os.walk(local(path)):
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(folder, name), "wb") as f:
                    f.write(b"no parquet")
                crc = os.path.join(folder, f".{name}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
                return


def fact(spark, path, schema=SCHEMA):
    return rows(versions.read(spark, path, spark.createDataFrame([], schema).schema), "symbol", "date_key", "close")


class Died(Exception):
    pass


def die_before_the_log(monkeypatch):
    """Let a publication die when its data are written and its rows in the log are not."""
    real, calls = versions._log, []
    real_part = versions._part
    monkeypatch.setattr(versions, "_part", lambda c: calls.append(None) or real_part(c))
    monkeypatch.setattr(versions, "_log", lambda spark, path: (_ for _ in ()).throw(Died) if calls else real(spark, path))


def test_an_unreadable_file_fails_the_run_and_keeps_the_table(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    path = scratch_path(spark, "t-spoilt")
    incremental.full_refresh(spark.createDataFrame([("A", d(1), 1.0), ("B", d(1), 1.0)], SCHEMA), path, "date_key")
    spoil(f"{path}/data")
    before = sorted(os.listdir(local(f"{path}/versions")))
    with pytest.raises(Exception):
        incremental.incremental_refresh(spark, path, spark.createDataFrame([("A", d(1), 2.0), ("A", d(2), 2.0)], SCHEMA), ["symbol", "date_key"], "date_key", schema, "close")
    assert sorted(os.listdir(local(f"{path}/versions"))) == before
    spoil(f"{path}/versions")
    with pytest.raises(Exception):
        incremental.incremental_refresh(spark, path, spark.createDataFrame([("A", d(2), 2.0)], SCHEMA), ["symbol", "date_key"], "date_key", schema)


def test_a_run_that_dies_changes_nothing_for_readers(spark, monkeypatch):
    schema = spark.createDataFrame([], SCHEMA).schema
    path = scratch_path(spark, "t-half")
    incremental.full_refresh(spark.createDataFrame([("A", d(i), 1.0) for i in range(3)], SCHEMA), path, "date_key")
    second = spark.createDataFrame([("A", d(i), 2.0) for i in range(6)], SCHEMA)
    with monkeypatch.context() as m:
        die_before_the_log(m)
        with pytest.raises(Died):
            incremental.incremental_refresh(spark, path, second, ["symbol", "date_key"], "date_key", schema)
    assert len(os.listdir(local(f"{path}/data"))) == 2  # the data were written
    assert fact(spark, path) == [("A", d(i), 1.0) for i in range(3)]
    incremental.incremental_refresh(spark, path, second, ["symbol", "date_key"], "date_key", schema)
    assert fact(spark, path) == [("A", d(i), 1.0 if i < 3 else 2.0) for i in range(6)]


def test_partitions_take_their_newest_version(spark):
    path = scratch_path(spark, "t-parts")
    table = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    days = lambda *n: spark.createDataFrame([(d(i),) for i in n], "date_key date")
    assert not versions.exists(spark, path)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path, table().schema)
    versions.publish(table(("A", d(1), 1.0), ("A", d(2), 1.0), ("A", d(3), 1.0), ("N", None, 1.0)), path, "date_key")
    versions.publish(table(("A", d(2), 2.0)), path, "date_key", touched=days(2, 3, 9))
    assert fact(spark, path) == [("A", d(1), 1.0), ("A", d(2), 2.0), ("N", None, 1.0)]
    assert versions.superseded(spark, path).count() == 2
    pruned = versions.read(spark, path, table().schema).where(F.col("date_key") == F.lit(d(1)))
    assert "PartitionFilters: [isnotnull(date_key" in pruned._jdf.queryExecution().executedPlan().toString() and rows(pruned, "symbol") == [("A",)]
    versions.publish(table(), path, "date_key")  # an empty table is a table
    assert fact(spark, path) == [] and versions.exists(spark, path)
    plain = scratch_path(spark, "t-plain")
    for k in (1.0, 2.0):
        versions.publish(table(("A", d(1), k)), plain)
    assert fact(spark, plain) == [("A", d(1), 2.0)]
    bad = scratch_path(spark, "t-bad")
    versions.publish(spark.createDataFrame([("a b/c", 1)], "p string, v int"), bad, "p")
    with pytest.raises(ValueError):
        versions.read(spark, bad, spark.createDataFrame([], "p string, v int").schema)


def test_look_back_equals_a_full_refresh(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    old = spark.createDataFrame([("A", d(i), 1.0) for i in range(8)] + [("B", d(i), 1.0) for i in (0, 7)], SCHEMA)
    new = spark.createDataFrame([("A", d(i), 1.0 if i < 5 else 2.0) for i in range(10) if i != 6] + [("B", d(i), 1.0) for i in (0, 5)], SCHEMA)
    month = lambda df: df.withColumn("date_month", F.trunc("date_key", "month"))
    for part, of in (("date_key", lambda df: df), ("date_month", month)):
        path = scratch_path(spark, "t-lookback")
        for df in (old, new):
            incremental.incremental_refresh(spark, path, of(df), ["symbol", "date_key"], part, of(df).schema, "date_key", lookback_days=3)
        got = versions.read(spark, path, of(new).schema)
        same(got, of(new))
        incremental.incremental_refresh(spark, path, of(old), ["symbol", "date_key"], part, of(old).schema, "date_key")
        assert got.count() == new.count()  # without a look-back older days are left alone
    with pytest.raises(ValueError):
        incremental.watermark_filter(new, old, lookback_days=-1)


@needs_data
def test_look_back_of_the_stateful_refresh(spark):
    raw, comp = fx.fx_candles(spark, SF), R.star(spark, SF).dim_companies
    day = F.col("trading_date")
    first = raw.where((day <= F.lit(dt.date(2024, 1, 20))) & ~((day > F.lit(dt.date(2024, 1, 15))) & (F.col("event_id") % 4 == 0)))
    target, state = scratch_path(spark, "t-f"), scratch_path(spark, "t-s")
    price_state.refresh_prices(spark, first, first, comp, target, state, ["event_id"])
    price_state.refresh_prices(spark, raw.join(first.select("event_id"), "event_id", "left_anti").select(*raw.columns), raw, comp, target, state, ["event_id"], lookback_days=6)
    want = full_fact(raw, comp)
    same(versions.read(spark, target, want.schema), want)


def test_snapshot_log_is_only_added_to(spark, monkeypatch):
    schema = "symbol string, name string"
    path = scratch_path(spark, "t-snap")
    current = lambda *pairs: spark.createDataFrame(pairs, schema)
    run = lambda df, day: snapshot.run_snapshot(spark, path, df, "symbol", ["name"], dt.datetime(2024, 1, day))
    run(current(("A", "a"), ("B", "b"), (None, "n")), 1)
    run(current(("A", "a2"), ("B", "b"), (None, "n")), 2)
    files = {f: os.stat(f).st_mtime_ns for folder, _, names in os.walk(local(f"{path}/data")) for f in (os.path.join(folder, n) for n in names)}
    with monkeypatch.context() as m:
        die_before_the_log(m)
        with pytest.raises(Died):
            run(current(("A", "a3"), ("B", "b")), 3)
    run(current(("A", "a3"), ("B", None), (None, "n")), 4)
    run(current(("A", "a3"), ("B", "b"), (None, "n")), 4)  # the run repeated, B as it was
    run(current(("A", "a3")), 5)
    table = snapshot.read_snapshot(spark, path, current(("A", "a")).schema)
    t = lambda day: dt.datetime(2024, 1, day)
    assert rows(table, "symbol", "name", "valid_from", "valid_to", "is_current") == [
        ("A", "a", t(1), t(2), False), ("A", "a2", t(2), t(4), False), ("A", "a3", t(4), None, True), ("B", "b", t(1), None, True), (None, "n", t(1), None, True)]
    assert all(os.stat(f).st_mtime_ns == at for f, at in files.items())
    assert rows(snapshot.read_snapshot(spark, path, current(("A", "a")).schema, open_only=True), "symbol") == [("A",), ("B",), (None,)]


def test_a_cluster_needs_the_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError):
        checkpoint_root(Session)


def full_fact(raw, companies):
    return marts.fct_daily_prices(staging.stg_candles(raw, tiebreak=["event_id"]), companies).select(*FACT_PRICE_COLUMNS)


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@needs_data
def test_first_run_and_skipped_landing_take_every_symbol(spark):
    raw, comp = fx.fx_candles(spark, SF), R.star(spark, SF).dim_companies
    two = F.upper(F.trim("symbol")).isin("U1", "U2")
    cut = F.col("trading_date") <= F.lit(dt.date(2024, 1, 15))
    target, state = scratch_path(spark, "t-f"), scratch_path(spark, "t-s")
    price_state.refresh_prices(spark, raw.where(cut & two), raw.where(cut), comp, target, state, ["event_id"])
    same(versions.read(spark, target, full_fact(raw, comp).schema), full_fact(raw.where(cut), comp))
    # the second run is only told of two symbols' landing, the rest was skipped
    later = raw.withColumn("_loaded_at", F.when(cut, F.col("_loaded_at")).otherwise(F.col("_loaded_at") + F.expr("INTERVAL 30 DAYS")))
    price_state.refresh_prices(spark, later.where(~cut & two), later, comp, target, state, ["event_id"])
    first = full_fact(raw.where(cut), comp)
    newest = first.agg(F.max("date_key")).first()[0]
    same(versions.read(spark, target, full_fact(raw, comp).schema), first.unionByName(full_fact(later, comp).where(F.col("date_key") > F.lit(newest))))


@needs_data
def test_a_stateless_run_between_stateful_ones(spark):
    c, p, f = fx.fx_candles(spark, SF), fx.fx_profiles(spark, SF), fx.fx_financials(spark, SF)
    schemas = {"candles": c.schema, "company_profiles": p.schema, "company_financials": f.schema}
    root, out, seed = (scratch_path(spark, n) for n in ("t-raw", "t-out", "t-seed"))
    fx.fx_sector_map(spark, SF).write.option("header", True).csv(seed)
    WR.write_raw_period(p, root, "company_profiles", dt.date(2024, 1, 31), "month")
    WR.write_raw_period(f, root, "company_financials", dt.date(2024, 1, 31), "month")
    day = F.col("trading_date")
    waves = [c.where(day <= F.lit(dt.date(2024, 1, 10))), c.where(day.between(dt.date(2024, 1, 11), dt.date(2024, 1, 20))), c.where(day > F.lit(dt.date(2024, 1, 20)))]
    restated = waves[0].withColumns({"close": F.col("close") * 3, "_loaded_at": F.col("_loaded_at") + F.expr("INTERVAL 9 DAYS"), "event_id": F.col("event_id") + 10_000_000})
    build = lambda n, new: build_warehouse(spark, root, seed, out, dt.date(2025, 1, 15), dt.datetime(2024, 2, n), schemas, news_enabled=False, new_candles=new)
    WR.write_raw_period(waves[0], root, "candles", dt.date(2024, 1, 10), "day")
    build(1, waves[0])
    WR.write_raw_period(waves[1].unionByName(restated), root, "candles", dt.date(2024, 1, 20), "day")
    build(2, None)
    WR.write_raw_period(waves[2], root, "candles", dt.date(2024, 1, 30), "day")
    got = build(3, waves[2])["fct_daily_prices"].where("date_key > date '2024-01-20'")
    whole = read_raw(spark, root, "candles", schema=c.schema)
    same(got.select(*FACT_PRICE_COLUMNS), full_fact(whole, marts.dim_companies(fx.fx_sector_map(spark, SF), staging.stg_company_profiles(p, fx.fx_sector_map(spark, SF)))).where("date_key > date '2024-01-20'"))


@needs_data
def test_raw_candles_are_staged_once(spark):
    c, p, f = fx.fx_candles(spark, SF), fx.fx_profiles(spark, SF), fx.fx_financials(spark, SF)
    root, out, seed = (scratch_path(spark, n) for n in ("t-raw", "t-out", "t-seed"))
    fx.fx_sector_map(spark, SF).write.option("header", True).csv(seed)
    WR.write_raw_partitioned(c, root, "candles")
    WR.write_raw_period(p, root, "company_profiles", dt.date(2024, 1, 31), "month")
    WR.write_raw_period(f, root, "company_financials", dt.date(2024, 1, 31), "month")
    models = build_warehouse(spark, root, seed, out, dt.date(2025, 1, 15), dt.datetime(2024, 2, 1),
                             {"candles": c.schema, "company_profiles": p.schema, "company_financials": f.schema}, news_enabled=False)
    for name, df in models.items():
        assert f"{root}/candles" not in df._jdf.queryExecution().optimizedPlan().toString(), name
        assert not any(f"{local(root)}/candles" in path for path in df.inputFiles()), name
