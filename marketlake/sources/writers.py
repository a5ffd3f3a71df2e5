"""Raw sinks: Hive-partitioned Parquet per trading day or run period (S-12, S-13)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.sources.raw import conform_numeric


def _pad2(c):
    return F.lpad(c.cast("string"), 2, "0")


def write_raw_partitioned(df: DataFrame, root: str, table: str = "candles", date_col: str = "trading_date") -> None:
    """S-12: split by trading day into ``year=/month=/day=`` directories
    (month and day zero-padded).  Dynamic partition overwrite: re-writing a
    day replaces that day only; an empty frame writes nothing.

    ``REBALANCE(year, month, day)`` before the write: each light day becomes
    one file (a backfill of years is one file per day, not one per day and
    upstream task), while AQE splits a skewed day, or a group of duplicate
    loads holding a third of the rows, over several writer tasks.
    """
    d = F.col(date_col)
    out = (conform_numeric(df, table).withColumn("year", F.year(d).cast("string"))
             .withColumn("month", _pad2(F.month(d)))
             .withColumn("day", _pad2(F.dayofmonth(d))))
    (out.hint("rebalance", "year", "month", "day")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day").parquet(f"{root}/{table}"))


def period_values(run_date: dt.date, period: str) -> dict[str, str]:
    """Partition values of a run: day -> year/month/day, week -> ISO
    week-year/week, month -> year/month (zero-padded)."""
    if period == "day":
        return {"year": str(run_date.year), "month": f"{run_date.month:02d}", "day": f"{run_date.day:02d}"}
    if period == "week":
        iso = run_date.isocalendar()
        # ISO week-year, not the calendar year: 2025-12-30 is week 1 of 2026.
        return {"year": str(iso[0]), "week": f"{iso[1]:02d}"}
    if period == "month":
        return {"year": str(run_date.year), "month": f"{run_date.month:02d}"}
    raise ValueError(f"unknown period {period!r}")


def write_raw_period(df: DataFrame, root: str, table: str, run_date: dt.date, period: str) -> None:
    """S-13: one object per run period; re-running the period overwrites it.
    Profiles have one object for each run day of the month, so a run replaces
    only what the same day's run wrote."""
    vals = period_values(run_date, period)
    if table == "company_profiles":
        vals["run_day"] = run_date.isoformat()
    out = conform_numeric(df, table)
    for k, v in vals.items():
        out = out.withColumn(k, F.lit(v))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*vals).parquet(f"{root}/{table}"))
