"""Property tests: operators against a pandas brute force on random inputs."""

import datetime as dt
import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marketlake.operators import timeseries
from marketlake.operators.dedup import dedup_latest

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

row = st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 4), st.integers(0, 5),
                st.one_of(st.none(), st.integers(-3, 3)))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_dedup_matches_sort_and_take_first(spark, data):
    df = spark.createDataFrame(data, "k string, d int, ts int, v int")
    got = sorted(tuple(r) for r in dedup_latest(df, ["k", "d"], ["ts"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "d", "ts", "v"])
    # newest ts first; ties -> greatest v, NULL smallest
    pdf["v"] = pd.to_numeric(pdf["v"])
    pdf["vkey"] = pdf["v"].fillna(-10**9)
    want = (pdf.sort_values(["k", "d", "ts", "vkey"], ascending=[True, True, False, False])
            .groupby(["k", "d"]).head(1))
    want = sorted((r.k, r.d, r.ts, None if pd.isna(r.v) else int(r.v)) for r in want.itertuples())
    assert got == want


series = st.lists(st.tuples(st.floats(0.5, 200, allow_nan=False), st.integers(1, 50)), min_size=1, max_size=45)


@SETTINGS
@given(series, series)
def test_price_features_match_brute_force(spark, s1, s2):
    base = dt.date(2024, 1, 1)
    data = [(sym, base + dt.timedelta(days=i), c, c, c, c, v, dt.datetime(2024, 1, 1))
            for sym, s in (("A", s1), ("B", s2)) for i, (c, v) in enumerate(s)]
    df = spark.createDataFrame(data, "symbol string, date_key date, open double, high double, low double, "
                                     "close double, volume long, _loaded_at timestamp_ntz")
    got = {(r.symbol, r.date_key): r for r in timeseries.price_features(df).collect()}
    for sym, s in (("A", s1), ("B", s2)):
        cum = 0.0
        for i in range(1, len(s)):
            c, p = s[i][0], s[i - 1][0]
            r = got[(sym, base + dt.timedelta(days=i))]
            assert math.isclose(r.daily_return, (c - p) / p, rel_tol=1e-12, abs_tol=1e-15)
            cum += math.log(c / p)
            assert math.isclose(r.cumulative_return, math.exp(cum) - 1, rel_tol=1e-9, abs_tol=1e-12)
            window = [v for _, v in s[max(0, i - 19): i + 1]]
            mean = sum(window) / len(window)
            assert math.isclose(r.volume_sma_20, mean, rel_tol=1e-12)
            std = math.sqrt(sum((v - mean) ** 2 for v in window) / len(window))
            if std > 1e-9:
                assert math.isclose(r.volume_zscore, (s[i][1] - mean) / std, rel_tol=1e-6, abs_tol=1e-9)
        assert len([k for k in got if k[0] == sym]) == len(s) - 1
