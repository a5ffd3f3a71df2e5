import datetime as dt

from pyspark.sql import functions as F

from marketlake.operators import incremental as INC
from marketlake.operators import layout as LAY
from marketlake.operators import versions
from marketlake.operators.snapshot import scd2_apply
from marketlake.session import scratch_path
from tests.conftest import rows

SCHEMA = "symbol string, date_key date, close double"


def d(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def test_watermark_is_global_and_strict(spark):
    target = spark.createDataFrame([("A", d(2), 1.0)], SCHEMA)
    fresh = spark.createDataFrame([("A", d(3), 2.0), ("B", d(2), 5.0), ("B", d(1), 5.0)], SCHEMA)
    # the late symbol B at the watermark day is ignored
    assert rows(INC.watermark_filter(fresh, target), "symbol", "date_key") == [("A", d(3))]
    assert INC.watermark_filter(fresh, None).count() == 3


def test_upsert_replaces_and_adds(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    path = scratch_path(spark, "t-upsert")
    INC.full_refresh(spark.createDataFrame([("A", d(1), 1.0), ("A", d(2), 1.0), ("B", d(2), 1.0)], SCHEMA),
                     path, "date_key")
    upd = spark.createDataFrame([("A", d(2), 2.0), ("C", d(3), 3.0)], SCHEMA)
    INC.keyed_upsert(spark, path, upd, ["symbol", "date_key"], "date_key", schema)
    INC.keyed_upsert(spark, path, upd, ["symbol", "date_key"], "date_key", schema)  # idempotent
    got = rows(versions.read(spark, path, schema), "symbol", "date_key", "close")
    assert got == [("A", d(1), 1.0), ("A", d(2), 2.0), ("B", d(2), 1.0), ("C", d(3), 3.0)]


def test_incremental_equals_full_refresh_without_late_data(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    all_rows = [("A", d(i), float(i)) for i in range(6)] + [("B", d(i), float(-i)) for i in range(6)]
    full = spark.createDataFrame(all_rows, SCHEMA)
    inc_path, full_path = scratch_path(spark, "t-inc"), scratch_path(spark, "t-full")
    INC.incremental_refresh(spark, inc_path, full.where(F.col("date_key") <= d(2)), ["symbol", "date_key"],
                            "date_key", schema)
    INC.incremental_refresh(spark, inc_path, full, ["symbol", "date_key"], "date_key", schema)
    INC.full_refresh(full, full_path, "date_key")
    a = versions.read(spark, inc_path, schema)
    b = versions.read(spark, full_path, schema)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_month_partition_write_prunes(spark):
    df = LAY.month_partition(spark.createDataFrame([("A", d(i * 20), 1.0) for i in range(5)], SCHEMA))
    path = scratch_path(spark, "t-month")
    LAY.write_partitioned(df, path, "date_month", cluster_cols=["symbol"])
    back = spark.read.schema(df.schema).parquet(path).where(F.col("date_month") == F.lit(dt.date(2024, 2, 1)))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan
    assert rows(back, "date_key") == [(d(40),)]
    # a plain date-range read adds the month predicate and so prunes too
    ranged = spark.read.schema(df.schema).parquet(path).where(
        LAY.date_range_filter(d(35), d(45), month_col="date_month"))
    assert "PartitionFilters: [isnotnull(date_month" in ranged._jdf.queryExecution().executedPlan().toString()
    assert rows(ranged, "date_key") == [(d(40),)]


PROF = "symbol string, name string, cap double, _loaded_at timestamp_ntz"
R1, R2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def test_scd2_cases(spark):
    g1 = spark.createDataFrame([("NULL2V", None, 1.0, R1), ("SAME", "s", 1.0, R1), ("LOADONLY", "l", 1.0, R1),
                                ("CHG", "c", 1.0, R1), ("GONE", "g", 1.0, R1)], PROF)
    g2 = spark.createDataFrame([("NULL2V", "now", 1.0, R2), ("SAME", "s", 1.0, R1), ("LOADONLY", "l", 1.0, R2),
                                ("CHG", "c", 2.0, R2), ("NEW", "n", 1.0, R2)], PROF)
    h1 = scd2_apply(None, g1, "symbol", ["name", "cap"], R1)
    h2 = scd2_apply(h1, g2, "symbol", ["name", "cap"], R2)
    got = rows(h2, "symbol", "cap", "valid_from", "valid_to", "is_current")
    assert got == [
        ("CHG", 1.0, R1, R2, False), ("CHG", 2.0, R2, None, True),
        ("GONE", 1.0, R1, None, True),
        ("LOADONLY", 1.0, R1, None, True),
        ("NEW", 1.0, R2, None, True),
        ("NULL2V", 1.0, R1, R2, False), ("NULL2V", 1.0, R2, None, True),
        ("SAME", 1.0, R1, None, True),
    ]
    # invariants: one current row per key; closed rows keep their history on re-run
    cur = h2.where("is_current").groupBy("symbol").count().where("count > 1").count()
    assert cur == 0
    h3 = scd2_apply(h2, g2, "symbol", ["name", "cap"], dt.datetime(2024, 3, 1))
    assert h3.count() == h2.count()
