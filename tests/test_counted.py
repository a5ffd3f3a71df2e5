"""Row tests counted by the write that makes a table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators import incremental, suite, versions
from marketlake.plans import fixtures as fx
from marketlake.plans import registry as R
from marketlake.plans.build import VIEWS, build_warehouse, run_warehouse_tests
from marketlake.session import scratch_path
from marketlake.sources import writers as WR
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
SCHEMA = "symbol string, date_key date, close double, volume long, sector string"
TESTS = [("t", "not_null", "close", None), ("t", "between", "close", (0, 100)), ("t", "assert_positive_volume", "volume", None),
         ("t", "accepted_values", "sector", "sectors")]


def d(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def by_scan(df):
    return rows(suite.run_quality_suite({"t": df}, TESTS, ["A", "B"]))


def by_counts(df, path):
    return rows(suite.run_quality_suite({"t": df}, TESTS, ["A", "B"], written={"t": path}))


def spoil_data(path):
    for folder, _, names in os.walk(path.removeprefix("file:") + "/data"):
        for name in names:
            if name.endswith((".parquet", ".crc")):
                with open(os.path.join(folder, name), "wb") as f:
                    f.write(b"no parquet")


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_counts_follow_the_table_through_its_versions(spark):
    path, counts = scratch_path(spark, "t-counted"), suite.row_counts("t", TESTS, ["A", "B"])
    first = table(spark, [("a", d(0), None, 1, "A"), ("a", d(1), 5.0, 0, "C"), ("b", d(1), 500.0, 3, None), ("b", d(2), 1.0, 3, "D")])
    schema = first.schema

    def check():
        df = versions.read(spark, path, schema)
        assert by_counts(df, path) == by_scan(df)

    versions.publish(first, path, "date_key", "symbol", counts=counts)
    check()
    # a day with failing rows is replaced, one more is added: the first version is read in part
    incremental.keyed_upsert(spark, path, table(spark, [("a", d(0), 7.0, 1, "A"), ("c", d(3), -1.0, 1, "B")]), ["symbol", "date_key"], "date_key", schema, counts=counts)
    check()
    # a version without counts
    incremental.keyed_upsert(spark, path, table(spark, [("c", d(4), None, 0, "E")]), ["symbol", "date_key"], "date_key", schema)
    check()
    # a day is emptied
    gone = table(spark, [("c", d(4), None, 0, "E")])
    incremental.keyed_upsert(spark, path, table(spark, [("c", d(5), 1.0, 1, "B")]), ["symbol", "date_key"], "date_key", schema, replaced=gone, counts=counts)
    check()
    # rewritten whole, then empty
    versions.publish(table(spark, [("z", d(0), None, 0, "Z"), ("z", d(1), None, 0, "Z")]), path, "date_key", "symbol", counts=counts)
    check()
    versions.publish(table(spark, []), path, "date_key", "symbol", counts=counts)
    check()
    # a test that is declared otherwise is no kept one
    other = [("t", "between", "close", (10, 20))]
    versions.publish(first, path, "date_key", "symbol", counts=counts)
    df = versions.read(spark, path, schema)
    got = suite.run_quality_suite({"t": df}, other, written={"t": path}).first()
    assert got.failures == 3 == suite.run_quality_suite({"t": df}, other).first().failures


def test_row_tests_of_a_written_table_read_none_of_its_rows(spark):
    path, tests = scratch_path(spark, "t-unread"), TESTS[:3]
    df = table(spark, [("a", d(i % 5), None if i % 3 else 5.0, i % 4, "A") for i in range(60)]).repartition(4)
    versions.publish(df, path, "date_key", "symbol", counts=suite.row_counts("t", tests))
    read = versions.read(spark, path, df.schema)
    want = rows(suite.run_quality_suite({"t": df}, tests))
    spoil_data(path)
    assert rows(suite.run_quality_suite({"t": read}, tests, written={"t": path})) == want
    with pytest.raises(Exception):
        suite.run_quality_suite({"t": read}, tests).collect()
    # versions without failing rows say so for any of their days, however many were replaced
    clean, counts = scratch_path(spark, "t-clean"), suite.row_counts("t", tests)
    versions.publish(table(spark, [("a", d(i), 1.0, 1, "A") for i in range(5)]), clean, "date_key", "symbol", counts=counts)
    incremental.keyed_upsert(spark, clean, table(spark, [("a", d(1), 2.0, 1, "A")]), ["symbol", "date_key"], "date_key", df.schema, counts=counts)
    spoil_data(clean)
    assert set(versions.counted(spark, clean, df.schema, counts).values()) == {0}


def test_a_table_without_an_exchange_and_an_empty_one(spark):
    path, counts = scratch_path(spark, "t-flat"), suite.row_counts("t", TESTS, ["A", "B"])
    for data in ([("a", d(0), None, 0, "C"), ("a", d(0), None, 5, "C")], [], [("a", d(0), 101.0, 1, "A")]):
        versions.publish(table(spark, data), path, counts=counts)
        df = versions.read(spark, path, table(spark, []).schema)
        assert by_counts(df, path) == by_scan(df)
    with pytest.raises(FileNotFoundError):
        versions.counted(spark, f"{path}/none", df.schema, counts)


def test_counts_are_taken_behind_the_last_exchange(spark):
    """In the stage that writes, a task that runs again is counted once."""
    path, counts = scratch_path(spark, "t-once"), suite.row_counts("t", TESTS[:1])
    df = table(spark, [(f"s{i}", d(i % 7), None, 1, "A") for i in range(500)]).repartition(8)
    seen = []
    real = versions.clustered
    try:
        versions.clustered = lambda df, p, c, watch: seen.append(real(df, p, c, watch)) or seen[-1]
        versions.publish(df, path, "date_key", "symbol", counts=counts)
    finally:
        versions.clustered = real
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Sort") < plan.index("CollectMetrics") < plan.index("RebalancePartitions")
    assert list(versions.counted(spark, path, df.schema, counts).values()) == [500]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_a_warehouse_run_answers_its_row_tests_from_its_writes(spark):
    c, p, f, n = fx.fx_candles(spark, SF), fx.fx_profiles(spark, SF), fx.fx_financials(spark, SF), fx.fx_news(spark, SF)
    schemas = {"candles": c.schema, "company_profiles": p.schema, "company_financials": f.schema, "company_news": n.schema}
    seed, raw, out = scratch_path(spark, "t-seed"), scratch_path(spark, "t-raw"), scratch_path(spark, "t-out")
    fx.fx_sector_map(spark, SF).write.option("header", True).csv(seed)

    def run(candles, day):
        WR.write_raw_partitioned(candles, raw, "candles")
        return build_warehouse(spark, raw, seed, out, R.AS_OF, dt.datetime(2024, 2, day), schemas)

    for df, t, period in ((p, "company_profiles", "month"), (f, "company_financials", "month"), (n, "company_news", "week")):
        WR.write_raw_period(df, raw, t, dt.date(2024, 1, 31), period)
    cut = F.lit(dt.date(2024, 1, 15))
    run(c.where(F.col("trading_date") <= cut), 1)
    models = run(c.where(F.col("trading_date") > cut), 2)
    got = run_warehouse_tests(models, out)
    assert rows(got) == rows(run_warehouse_tests(models)) and len(rows(got)) == len(suite.DECLARED_TESTS)
    # models whose row tests are counted hold these alone: their rows need not be there
    only_rows = [t for t in suite.DECLARED_TESTS if t[1] in suite._ROW_TESTS - {"accepted_values"} and t[0] not in VIEWS]
    want = rows(suite.run_quality_suite(models, only_rows))
    tables = {m: models[m] for m, *_ in only_rows}
    quiet = suite.run_quality_suite(tables, only_rows, written={m: f"{out}/{m}" for m in tables})
    assert rows(quiet) == want and "Scan parquet" not in quiet._jdf.queryExecution().executedPlan().toString()
