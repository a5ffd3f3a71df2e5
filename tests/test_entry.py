import os

import pytest

import __spark_entry__ as E
from scripts.oracle_check import check

SF_SMALL = "/root/testdata/sf0.001"


def test_registry_keys_have_oracles():
    from marketlake.plans.registry import QUERIES

    q, o = E.queries(), E.oracle_sql()
    assert len(QUERIES) >= 65 and set(QUERIES) <= set(q) and set(o) <= set(q)
    missing = set(QUERIES) - set(o)
    assert not missing, f"keys without oracle SQL: {missing}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date_key", "sector", "avg_daily_return", "avg_daily_return_pct", "cumulative_return",
                          "cumulative_return_pct"]


FAST = ["stg_candles", "fct_daily_prices", "sector_performance", "sector_volatility", "dim_dates",
        "stg_company_profiles", "scd2_snapshot", "keyed_upsert", "flatten_candles"]


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver test data not present")
def test_oracle_subset(spark):
    keys = None if os.environ.get("MARKETLAKE_FULL_ORACLE") else FAST
    res = check(spark, SF_SMALL, keys, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad
