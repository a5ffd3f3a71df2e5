import datetime as dt
import math

from marketlake.operators import marts, timeseries
from tests.conftest import rows

STG = "symbol string, date_key date, open double, high double, low double, close double, volume long, _loaded_at timestamp_ntz"
T = dt.datetime(2024, 1, 1)


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def test_zero_previous_close(spark):
    df = spark.createDataFrame([("A", day(i), 1.0, 1.0, 1.0, c, 10, T) for i, c in enumerate([0.0, 5.0, 6.0])], STG)
    r = rows(timeseries.daily_returns(df), "date_key", "daily_return", "log_return")
    assert r[0] == (day(1), None, None)
    assert r[1][0] == day(2) and abs(r[1][1] - 0.2) < 1e-12 and abs(r[1][2] - math.log(1.2)) < 1e-12


def test_first_row_has_volume_stats_but_no_return(spark):
    df = spark.createDataFrame([("A", day(0), 1.0, 1.0, 1.0, 5.0, 7, T)], STG)
    assert timeseries.daily_returns(df).count() == 0
    v = timeseries.volume_stats(df).first()
    assert (v.volume_sma_20, v.volume_stddev_20, v.volume_zscore) == (7.0, 0.0, None)


def test_flat_volume_zscore_null(spark):
    df = spark.createDataFrame([("A", day(i), 1.0, 1.0, 1.0, 5.0, 7, T) for i in range(20)], STG)
    assert {r[0] for r in timeseries.volume_stats(df).select("volume_zscore").collect()} == {None}


def test_rolling_window_is_20_rows(spark):
    df = spark.createDataFrame([("A", day(i), 1.0, 1.0, 1.0, 5.0, i + 1, T) for i in range(25)], STG)
    last = timeseries.volume_stats(df).orderBy("date_key").collect()[-1]
    assert last.volume_sma_20 == sum(range(6, 26)) / 20


def test_cumulative_return_telescopes(spark):
    closes = [10.0, 11.0, 9.5, 12.0, 12.5]
    df = spark.createDataFrame([("A", day(i), 1.0, 1.0, 1.0, c, 1, T) for i, c in enumerate(closes)], STG)
    comp = spark.createDataFrame([("A", "S")], "symbol string, sector string")
    fact = marts.fct_daily_prices(df, comp).orderBy("date_key").collect()
    assert len(fact) == 4 and abs(fact[-1].cumulative_return - (12.5 / 10.0 - 1)) < 1e-12
    assert all(r.sector == "S" for r in fact)


def test_fused_features_equal_separate_operators(spark):
    data = [("A" if i % 2 else "B", day(i // 2), 1.0, 1.0, 1.0, 1.0 + (i * 7 % 5), (i * 3) % 11, T) for i in range(80)]
    df = spark.createDataFrame(data, STG).where("volume > 0")
    fused = timeseries.price_features(df).select("symbol", "date_key", "daily_return", "log_return",
                                                 "volume_sma_20", "volume_zscore")
    sep = (timeseries.daily_returns(df).join(timeseries.volume_stats(df), ["symbol", "date_key"])
           .select("symbol", "date_key", "daily_return", "log_return", "volume_sma_20", "volume_zscore"))
    assert fused.exceptAll(sep).count() == 0 and sep.exceptAll(fused).count() == 0
