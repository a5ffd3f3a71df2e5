import datetime as dt

from marketlake.operators import marts, metrics
from tests.conftest import rows

T = dt.datetime(2024, 1, 1)
PROF = ("symbol string, company_name string, sector string, industry string, country string, market_cap double, "
        "ipo_date date, logo_url string, web_url string, exchange string, _loaded_at timestamp_ntz")


def test_dim_companies_share_class_and_seed_only(spark):
    seed = spark.createDataFrame([("BRK.B", "Financials"), ("AAPL", "Technology")], "symbol string, sector string")
    prof = spark.createDataFrame([("BRK-B", "Berkshire", "X", "Insurance", "US", 1.0, None, "L", "W", "NYSE", T),
                                  ("ZZZ", "Zed", "X", None, "US", 1.0, None, "L", "W", "NYSE", T)], PROF)
    out = marts.dim_companies(seed, prof)
    assert rows(out, "symbol", "company_name", "sector", "exchange") == [
        ("AAPL", "AAPL", "Technology", None), ("BRK.B", "Berkshire", "Financials", "NYSE")]


def test_dim_dates_attributes(spark):
    c = spark.createDataFrame([(dt.date(2025, 12, 29),), (dt.date(2025, 12, 31),)], "date_key date")
    f = spark.createDataFrame([(dt.date(2026, 1, 4),)], "date_key date")
    out = marts.dim_dates(c, f, None, dt.date(2026, 1, 31)).orderBy("date_key").collect()
    assert [r.date_key for r in out] == [dt.date(2025, 12, 29) + dt.timedelta(days=i) for i in range(7)]
    r = out[1]  # 2025-12-30, a Tuesday in ISO week 1 of 2026
    assert (r.year, r.quarter, r.month, r.week_of_year, r.day_of_week, r.is_trading) == (2025, 4, 12, 1, 3, False)
    assert out[0].is_trading and out[2].is_trading and out[6].day_of_week == 1


def test_dim_dates_defaults_when_empty(spark):
    e = spark.createDataFrame([], "date_key date")
    out = marts.dim_dates(e, e, e, dt.date(2024, 12, 31))
    assert out.count() == 366


def test_date_spine_empty_when_reversed(spark):
    b = spark.createDataFrame([(dt.date(2024, 1, 5), dt.date(2024, 1, 1))], "min_date date, max_date date")
    assert marts.date_spine(b).count() == 0


FACT = "date_key date, sector string, daily_return double, log_return double"


def test_sector_volatility_month_end_cutoff(spark):
    data = [(dt.date(2023, 2, 27), "S", 0.9, 0.0), (dt.date(2023, 2, 28), "S", 0.1, 0.0),
            (dt.date(2024, 2, 29), "S", 0.3, 0.0), (dt.date(2024, 2, 29), None, 5.0, 0.0)]
    out = metrics.sector_volatility(spark.createDataFrame(data, FACT), dt.date(2024, 2, 29)).first()
    assert abs(out.annualized_return - 0.2 * 252) < 1e-9
    assert abs(out.annualized_volatility - 0.1 * 252 ** 0.5) < 1e-9


def test_sector_volatility_zero_std_ratio_null(spark):
    data = [(dt.date(2024, 1, 1), "S", 0.1, 0.0), (dt.date(2024, 1, 2), "S", 0.1, 0.0)]
    out = metrics.sector_volatility(spark.createDataFrame(data, FACT), dt.date(2024, 1, 31)).first()
    assert out.return_risk_ratio is None


def test_sector_performance_compounds_daily_means(spark):
    data = [(dt.date(2024, 1, 1), "S", 0.1, 0.1), (dt.date(2024, 1, 1), "S", 0.3, 0.3),
            (dt.date(2024, 1, 2), "S", None, None)]
    out = metrics.sector_performance(spark.createDataFrame(data, FACT)).orderBy("date_key").collect()
    import math
    assert abs(out[0].cumulative_return - (math.exp(0.2) - 1)) < 1e-12
    assert out[1].cumulative_return == out[0].cumulative_return and out[1].avg_daily_return is None


def test_monthly_top_worst_ties_by_name(spark):
    data = [(dt.date(2024, 1, 2), "B", 0.0, 0.1), (dt.date(2024, 1, 2), "A", 0.0, 0.1),
            (dt.date(2024, 1, 2), "C", 0.0, -0.2), (dt.date(2024, 2, 1), "C", 0.0, 0.5)]
    out = metrics.monthly_top_worst_sector(spark.createDataFrame(data, FACT)).orderBy("month_start").collect()
    assert (out[0].best_sector, out[0].worst_sector) == ("A", "C")
    assert (out[1].best_sector, out[1].worst_sector) == ("C", "C")


def test_outperformance_rank(spark):
    data = [(dt.date(2024, 1, 2), "A", 0.0, 0.1), (dt.date(2024, 1, 2), "B", 0.0, 0.3),
            (dt.date(2022, 1, 2), "A", 0.0, 9.0)]
    out = metrics.sector_outperformance_12m(spark.createDataFrame(data, FACT), dt.date(2024, 6, 30))
    assert rows(out, "rank", "sector") == [(1, "B"), (2, "A")]
