"""Command line: an ingest job, a warehouse run (build + data tests) or a freshness check.

    spark-submit --py-files marketlake.zip marketlake/__main__.py build --raw s3://.../raw --seed s3://.../seed.csv \
        --out s3://.../warehouse --as-of 2025-01-15
    python -m marketlake ingest --mode daily --landing ... --raw ... --as-of 2025-01-15
    python -m marketlake freshness --raw ... --as-of-ts "2025-01-15 06:00:00"

``build`` reads the landed raw tables, builds staging/marts/metrics (facts
incrementally), snapshots profiles, runs the declared data tests and exits
non-zero when a test fails (``--warn-only`` to report only).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="marketlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build the warehouse and run the data tests")
    b.add_argument("--raw", required=True, help="root of the landed raw tables (candles/, company_*/)")
    b.add_argument("--seed", default=None, help="sector seed CSV (symbol,sector with header; default: the shipped seed)")
    b.add_argument("--out", required=True, help="warehouse root (facts, dimensions, metrics, snapshot)")
    b.add_argument("--as-of", default=None, help="YYYY-MM-DD (default: today, UTC)")
    b.add_argument("--no-news", action="store_true", help="skip the news models")
    b.add_argument("--new-raw", default=None,
                   help="root of the raw tables landed by this run: refresh prices from the per-symbol state")
    b.add_argument("--lookback-days", type=int, default=0,
                   help="days before the watermark that are taken anew (late and restated rows)")
    b.add_argument("--reconcile", action="store_true",
                   help="read raw files that were landed with whole-number columns as INT64")
    b.add_argument("--warn-only", action="store_true", help="report failing data tests without a non-zero exit")
    b.add_argument("--full-refresh", action="store_true",
                   help="rebuild the facts from scratch (picks up late and restated rows)")
    i = sub.add_parser("ingest", help="flatten landed responses into the raw tables")
    i.add_argument("--mode", required=True, choices=["backfill", "daily", "news", "monthly"])
    i.add_argument("--landing", required=True, help="folder of the run's landed responses")
    i.add_argument("--raw", required=True, help="root of the raw tables")
    i.add_argument("--as-of", default=None, help="run day YYYY-MM-DD (default: today, UTC)")
    i.add_argument("--provider", default="auto", choices=["auto", "primary", "fallback"])
    i.add_argument("--switch", default="symbol", choices=["symbol", "later"],
                   help="auto: a denial switches its own symbol, or that and every later one")
    i.add_argument("--symbols", default=None, help="comma-separated symbols (default: the shipped universe)")
    f = sub.add_parser("freshness", help="freshness of the raw candles")
    f.add_argument("--raw", required=True, help="root of the landed raw tables")
    f.add_argument("--as-of-ts", default=None, help="YYYY-MM-DD HH:MM:SS (default: now, UTC)")
    args = ap.parse_args(argv)

    from marketlake.session import ensure_conf

    spark = SparkSession.builder.appName("marketlake").getOrCreate()
    ensure_conf(spark)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if args.cmd == "freshness":
        from marketlake.operators.quality import source_freshness
        from marketlake.sources.raw import read_raw

        at = dt.datetime.fromisoformat(args.as_of_ts) if args.as_of_ts else now
        r = source_freshness(read_raw(spark, args.raw, "candles"), at).first()
        print(f"raw_candles max_loaded_at={r.max_loaded_at} age_hours={r.age_hours} status={r.status}")
        return 2 if r.status == "error" else 0

    if args.cmd == "ingest":
        from marketlake.plans.ingest import run_ingest

        day = dt.date.fromisoformat(args.as_of) if args.as_of else now.date()
        rejects = run_ingest(spark, args.landing, args.raw, args.mode, day, now, args.provider, args.symbols, switch=args.switch)
        for r in rejects.groupBy("table", "reason").count().orderBy("table", "reason").toLocalIterator():
            print(f"REJECT {r.table}: {r['count']} payloads, {r.reason}")
        return 0

    from marketlake.plans.build import build_warehouse, run_warehouse_tests

    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else now.date()
    new_candles = None
    if args.new_raw:
        from marketlake.sources.raw import read_raw

        new_candles = read_raw(spark, args.new_raw, "candles")
    models = build_warehouse(spark, args.raw, args.seed, args.out, as_of, now, news_enabled=not args.no_news,
                             new_candles=new_candles, full_refresh=args.full_refresh, reconcile=args.reconcile,
                             lookback_days=args.lookback_days)
    results = run_warehouse_tests(models, args.out).orderBy("model", "test", "column_name").collect()
    failed = [r for r in results if r.status == "fail"]
    for r in results:
        print(f"{r.status.upper():4s} {r.model}.{r.test}({r.column_name}) failures={r.failures}")
    print(f"{len(results) - len(failed)} passed, {len(failed)} failed")
    return 1 if failed and not args.warn_only else 0


if __name__ == "__main__":
    sys.exit(main())
