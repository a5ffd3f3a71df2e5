import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from marketlake.session import scratch_path
from marketlake.sources import drift
from marketlake.sources import providers as PR
from marketlake.sources.raw import read_raw
from tests.conftest import rows

DAY = dt.date(2024, 1, 5)
PRICES = "open {0}, high double, low double, close double, volume {1}"


def land(spark, root, day, symbol, open_, volume, types):
    schema = f"symbol string, trading_date date, {PRICES.format(*types)}, _loaded_at timestamp"
    df = spark.createDataFrame([(symbol, DAY, open_, 1.5, 0.5, 1.25, volume, dt.datetime(2024, 1, 6))], schema)
    df.coalesce(1).write.mode("append").parquet(f"{root}/candles/year=2024/month=01/day={day:02d}")


@pytest.fixture()
def drifted(spark):
    root = scratch_path(spark, "t-drift")
    land(spark, root, 5, "D", 1.5, 2.5, ("double", "double"))
    land(spark, root, 5, "L", 1.5, 7, ("double", "long"))
    land(spark, root, 6, "B", 3, 8, ("long", "long"))
    land(spark, root, 6, "O", 4, None, ("long", "double"))
    land(spark, root, 7, "I", 1.5, 9, ("double", "int"))
    land(spark, root, 7, "F", 1.5, 0.5, ("float", "float"))
    return root


def test_files_of_every_numeric_type_read_together(spark, drifted):
    got = read_raw(spark, drifted, "candles", reconcile=True)
    assert dict(got.dtypes)["volume"] == dict(got.dtypes)["open"] == "double"
    assert rows(got, "symbol", "open", "volume", "day") == [
        ("B", 3.0, 8.0, 6), ("D", 1.5, 2.5, 5), ("F", 1.5, 0.5, 7), ("I", 1.5, 9.0, 7), ("L", 1.5, 7.0, 5), ("O", 4.0, None, 6)]
    with pytest.raises(Exception):
        read_raw(spark, drifted, "candles").collect()


def test_groups_and_partition_filter(spark, drifted):
    from marketlake.sources.raw import RAW_CANDLES, with_partition_fields

    schema = with_partition_fields(RAW_CANDLES, "candles")
    assert {k: len(v) for k, v in drift.drifted_files(spark, f"{drifted}/candles", schema).items()} == {("volume",): 1, ("open", "volume"): 1, ("open",): 1}
    some = read_raw(spark, drifted, "candles", partition_filter=F.col("day") == 5, reconcile=True)
    assert rows(some, "symbol") == [("D",), ("L",)]
    assert drift.drifted_files(spark, f"{drifted}/candles", schema, F.col("day") == 7) == {}
    plain = read_raw(spark, drifted, "candles", partition_filter=F.col("day") == 7, reconcile=True)
    assert "Union" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_broken_files_fail_and_missing_tables_are_empty(spark, drifted):
    with open(f"{drifted.removeprefix('file:')}/candles/year=2024/month=01/day=07/part-broken.parquet", "wb") as f:
        f.write(b"PAR1 not a table PAR1")
    with pytest.raises(Exception):
        read_raw(spark, drifted, "candles", reconcile=True).collect()
    assert read_raw(spark, f"{drifted}/none", "candles", missing_ok=True, reconcile=True).count() == 0
    with pytest.raises(Exception):
        read_raw(spark, f"{drifted}/none", "candles", reconcile=True)


def test_files_without_rows(spark):
    root = scratch_path(spark, "t-drift-empty")
    land(spark, root, 5, "L", 1.5, 7, ("double", "long"))
    spark.createDataFrame([], "symbol string, volume long").coalesce(1).write.mode("append").parquet(f"{root}/candles/year=2024/month=01/day=05")
    assert rows(read_raw(spark, root, "candles", reconcile=True), "symbol", "volume") == [("L", 7.0)]


def test_a_denial_switches_all_later_symbols(spark):
    both = lambda p: spark.createDataFrame([(s, p) for s in "ABCDE"], "symbol string, v string")
    order = spark.createDataFrame([(s, k) for k, s in enumerate("cabd")] + [(" D ", 9), (None, 0)], "symbol string, place int")
    pick = lambda *denied: "".join(v for _, v in rows(PR.provider_fallback(both("p"), both("f"), spark.createDataFrame([(d,) for d in denied], "symbol string"), order=order), "symbol", "v"))
    assert pick("b", "D") == "pfpfp"  # order C A B D; E has no place
    assert pick("C") == "ffffp"
    assert pick("E") == "ppppf"
    assert pick() == "ppppp"


def test_ingest_with_a_switch_for_good(spark):
    from marketlake.plans.ingest import run_ingest

    at = int(dt.datetime(2024, 1, 9, tzinfo=dt.timezone.utc).timestamp())
    landing, raw = (scratch_path(spark, n).removeprefix("file:") for n in ("t-land", "t-raw"))
    bars = {"s": "ok", "t": [at], **{c: [1.0] for c in "ohlcv"}}
    for folder, name, body in [("candles", "AAPL", bars), ("candles", "MSFT", {"error": "denied"}), ("candles", "NVDA", bars),
                               *[("fallback_candles", s, [{"Date": "2024-01-09", "Close": 7.0}]) for s in ("AAPL", "MSFT", "NVDA")]]:
        os.makedirs(f"{landing}/{folder}", exist_ok=True)
        with open(f"{landing}/{folder}/{name}.json", "w") as f:
            json.dump(body, f)
    run = lambda **more: run_ingest(spark, landing, raw, "daily", dt.date(2024, 1, 10), dt.datetime(2024, 2, 1), **more)
    run(symbols="AAPL,MSFT,NVDA", switch="later")
    assert rows(read_raw(spark, raw, "candles"), "symbol", "close") == [("AAPL", 1.0), ("MSFT", 7.0), ("NVDA", 7.0)]
    run(symbols="AAPL,MSFT,NVDA")
    assert rows(read_raw(spark, raw, "candles"), "symbol", "close") == [("AAPL", 1.0), ("MSFT", 7.0), ("NVDA", 1.0)]
    with pytest.raises(ValueError):
        run(switch="later", seed=spark.createDataFrame([("AAPL", "x")], "symbol string, sector string"))
    with pytest.raises(ValueError):
        run(switch="sometimes")
