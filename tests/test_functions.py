import datetime as dt

from pyspark.sql import functions as F

from marketlake.functions import (
    canonical_share_class, cents_to_dollars, classify_sector, epoch_seconds_to_date, normalize_symbol,
    round_to_long, safe_divide, surrogate_key,
)


def test_safe_divide_null_and_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(safe_divide("n", "d")).collect()]
    assert got == [None, None, 1.5]


def test_normalize_symbol_unicode_whitespace(spark):
    df = spark.createDataFrame([(" brk.b ",), ("\tmsft ",), (" aapl　",), (None,)], "s string")
    assert [r[0] for r in df.select(normalize_symbol("s")).collect()] == ["BRK.B", "MSFT", "AAPL", None]


def test_round_to_long_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (2.5,), (3.5,), (-2.5,)], "v double")
    assert [r[0] for r in df.select(round_to_long("v")).collect()] == [0, 1, 3, 4, -3]


def test_canonical_share_class_only_brk(spark):
    df = spark.createDataFrame([(" brk-b",), ("ABC-B",), ("BRK.B",)], "s string")
    assert [r[0] for r in df.select(canonical_share_class("s")).collect()] == ["BRK.B", "ABC-B", "BRK.B"]


def test_classifier_order_quirks(spark):
    df = spark.createDataFrame([("Biotechnology",), ("Utilities",), (None,), ("Oil & Gas",),
                                ("Electric Utility",), ("Banking",)], "i string")
    got = [r[0] for r in df.select(classify_sector("i")).collect()]
    assert got == ["Technology", "Financials", "Financials", "Energy", "Utilities", "Financials"]


def test_epoch_to_date_is_utc(spark):
    t = int(dt.datetime(2024, 3, 1, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp())
    df = spark.createDataFrame([(t,), (None,)], "t long")
    assert [r[0] for r in df.select(epoch_seconds_to_date("t")).collect()] == [dt.date(2024, 3, 1), None]


def test_cents_to_dollars(spark):
    df = spark.createDataFrame([(12345,), (1,)], "c long")
    assert [r[0] for r in df.select(cents_to_dollars("c")).collect()] == [123.45, 0.01]


def test_surrogate_key_null_safe(spark):
    df = spark.createDataFrame([("A", None), ("A", ""), (None, "A")], "a string, b string")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert len(set(keys)) == 3 and all(k is not None for k in keys)
    assert df.select(surrogate_key(F.lit("x"))).first()[0] == df.select(F.md5(F.lit("x"))).first()[0]


def test_date_to_epoch_roundtrip(spark):
    from marketlake.functions import date_to_epoch_seconds
    df = spark.createDataFrame([(dt.date(2024, 3, 1),)], "d date")
    t = df.select(date_to_epoch_seconds("d").alias("t")).first().t
    assert t == int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp())
    assert df.select(epoch_seconds_to_date(date_to_epoch_seconds("d"))).first()[0] == dt.date(2024, 3, 1)


def test_timestamps_are_zone_free(spark):
    from marketlake.operators.quality import source_freshness
    from marketlake.operators.snapshot import scd2_apply
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 12, 0),)], "_loaded_at timestamp_ntz")
        assert source_freshness(df, dt.datetime(2024, 3, 11, 12, 0)).first().age_hours == 48.0
        cur = spark.createDataFrame([("A", "x")], "symbol string, name string")
        run = dt.datetime(2024, 3, 10, 2, 30)  # a wall-clock time that does not exist in New York
        assert scd2_apply(None, cur, "symbol", ["name"], run).first().valid_from == run
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_zoned_instants_map_to_utc_dates(spark):
    from marketlake.operators import staging
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2024-01-01 03:00 UTC is still 2023-12-31 in New York: the key must be the UTC date
        df = spark.createDataFrame([("X", 1.0, 1704078000)], "symbol string, pe_ratio double, t long") \
            .select("symbol", "pe_ratio", F.timestamp_seconds("t").alias("_loaded_at"))
        assert staging.stg_company_financials(df).first().date_key == dt.date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
