"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is fully executed through the no-op sink (plan + run, no collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlake.operators import metrics  # noqa: E402
from marketlake.plans import fixtures as fx  # noqa: E402
from marketlake.plans.build import build_price_star  # noqa: E402
from marketlake.plans import registry as R  # noqa: E402
from marketlake.session import local_session  # noqa: E402

# Headline registry keys (same code path the correctness check runs).
KEYS = [
    "fct_daily_prices", "sector_performance", "sector_volatility", "stg_company_news",
    "stg_company_financials", "dim_dates", "compare_financials", "scd2_snapshot",
    # the write path
    "write_raw_partitioned", "keyed_upsert", "stream_price_refresh", "warehouse_build",
]


def scale_queries():
    """The flagship chain over lineitem-derived candles (largest input)."""
    def fact(spark, sf):
        return R.star_scale(spark, sf).fct_daily_prices

    def hot_fact(spark, sf):
        return build_price_star(fx.fx_candles_hot(spark, sf), fx.fx_sector_map_scale(spark, sf),
                                fx.fx_profiles(spark, sf)).fct_daily_prices

    return {
        "fct_daily_prices_scale": fact,
        "fct_daily_prices_hot_key": hot_fact,
        "sector_performance_scale": lambda s, sf: metrics.sector_performance(fact(s, sf)),
        "sector_volatility_scale": lambda s, sf: metrics.sector_volatility(fact(s, sf), R.AS_OF_LONG),
        "monthly_top_worst_scale": lambda s, sf: metrics.monthly_top_worst_sector(fact(s, sf)),
    }


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="marketlake-bench")
    todo = {**scale_queries(), **{k: R.QUERIES[k] for k in KEYS}}
    # Warm-up on a smaller scale (JIT, class loading), as the baseline probe
    # did: its sf0.1 runs followed sf0.001 and sf0.01 runs in the same session.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for fn in todo.values():
            run(fn(spark, warm))
    timings = {}
    for name, fn in todo.items():
        t0 = time.perf_counter()
        run(fn(spark, sf_dir))
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
