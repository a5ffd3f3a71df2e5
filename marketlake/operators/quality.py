"""Data-quality checks (D-1..D-9).

Each check returns the failing rows (or failing groups); an empty result
means the check passes.  Grouped checks aggregate map-side before the
shuffle, so a hot value is counted, never collected.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.columns import ntz_lit, utc_wall_clock


# Raw-candle freshness thresholds in hours.
FRESHNESS_WARN_HOURS = 36
FRESHNESS_ERROR_HOURS = 96


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D-1: rows with a NULL in any of ``cols`` (one pass for all columns),
    plus ``failed_columns`` naming them."""
    failed = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    return df.where(cond).withColumn("failed_columns", failed)


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """D-2: values of ``col`` seen more than once (NULLs ignored)."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def check_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D-3: combinations of ``cols`` seen more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def check_accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """D-4: values outside ``values`` with their counts (NULL passes)."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records")))


def check_relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """D-5: child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(parent_col).alias("__pk"))
    return (child.where(F.col(col).isNotNull())
            .join(keys, F.col(col) == F.col("__pk"), "left_anti"))


def check_between(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """D-6: rows outside ``[lo, hi]`` (inclusive; NULL passes)."""
    return df.where(~F.col(col).between(lo, hi))


def assert_positive_volume(fact: DataFrame) -> DataFrame:
    """D-7: fact rows with non-positive volume."""
    return fact.where(F.col("volume") <= 0)


def assert_valid_return_range(fact: DataFrame, limit: float = 0.5) -> DataFrame:
    """D-8: fact rows whose absolute daily return exceeds ``limit``."""
    return fact.where(F.abs(F.col("daily_return")) > limit)


def source_freshness(raw: DataFrame, as_of: dt.datetime, col: str = "_loaded_at",
                     warn_hours: float = FRESHNESS_WARN_HOURS,
                     error_hours: float = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """D-9: one row: newest load, its age in hours at ``as_of`` and a status."""
    newest = raw.agg(F.max(utc_wall_clock(raw, col).cast("timestamp_ntz")).alias("max_loaded_at"))
    now = ntz_lit(as_of)
    # difference computed on the values themselves (no zone conversion, so no DST shift)
    age = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now) / F.lit(3.6e9)
    return newest.select(
        "max_loaded_at",
        age.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age > error_hours, F.lit("error"))
        .when(age > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass")).alias("status"),
    )
