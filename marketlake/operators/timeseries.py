"""Per-symbol time-series windows (W-1..W-7).

All symbol windows share one specification, so Spark runs lag, the 20-row
mean/stddev and the running sum after a single ``symbol`` shuffle and sort.
Each window partition is one symbol's de-duplicated series: at most one row
per calendar day, so its size is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.columns import safe_divide

ROLLING_ROWS = 20


def symbol_window(key: str = "symbol", order: str = "date_key"):
    return Window.partitionBy(key).orderBy(order)


def with_prev_close(stg: DataFrame) -> DataFrame:
    """W-1: previous available close per symbol."""
    return stg.withColumn("prev_close", F.lag("close").over(symbol_window()))


def return_columns(close: str = "close", prev: str = "prev_close"):
    """W-2 expressions: simple return and guarded log return."""
    c, p = F.col(close), F.col(prev)
    daily = safe_divide(c - p, p)
    log_ret = F.when((p > 0) & (c > 0), F.ln(safe_divide(c, p)))
    return daily, log_ret


def daily_returns(stg: DataFrame) -> DataFrame:
    """W-2: returns per candle; the first row of each symbol is dropped."""
    daily, log_ret = return_columns()
    return (
        with_prev_close(stg)
        .where(F.col("prev_close").isNotNull())
        .select("symbol", "date_key", "open", "high", "low", "close", "volume",
                daily.alias("daily_return"), log_ret.alias("log_return"), "_loaded_at")
    )


def volume_stats(stg: DataFrame) -> DataFrame:
    """W-3..W-5 over all staged candles (first day included)."""
    w = symbol_window().rowsBetween(-(ROLLING_ROWS - 1), 0)
    return (
        stg.select("symbol", "date_key", "volume",
                   F.avg("volume").over(w).alias("volume_sma_20"),
                   F.stddev_pop("volume").over(w).alias("volume_stddev_20"))
        .withColumn("volume_zscore",
                    safe_divide(F.col("volume") - F.col("volume_sma_20"),
                                F.nullif(F.col("volume_stddev_20"), F.lit(0.0))))
    )


def cumulative(log_col: str, key: str = "symbol", order: str = "date_key"):
    """W-6/W-7: ``exp(running sum of log returns) - 1``; NULL counts as 0."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.exp(F.sum(F.coalesce(F.col(log_col), F.lit(0.0))).over(w)) - F.lit(1.0)


def price_features(stg: DataFrame) -> DataFrame:
    """Fused W-1..W-6: returns, volume statistics and cumulative return.

    Volume statistics are computed before the first row of each symbol is
    dropped; the running sum starts after it (its log return is NULL and
    counts as 0, so summing over all rows gives the same value).
    """
    w = symbol_window()
    w20 = w.rowsBetween(-(ROLLING_ROWS - 1), 0)
    daily, log_ret = return_columns()
    base = stg.select(
        "*",
        F.lag("close").over(w).alias("prev_close"),
        F.avg("volume").over(w20).alias("volume_sma_20"),
        F.stddev_pop("volume").over(w20).alias("volume_stddev_20"),
    )
    feats = base.select(
        "*",
        daily.alias("daily_return"),
        log_ret.alias("log_return"),
        safe_divide(F.col("volume") - F.col("volume_sma_20"),
                    F.nullif(F.col("volume_stddev_20"), F.lit(0.0))).alias("volume_zscore"),
    ).withColumn("cumulative_return", cumulative("log_return"))
    return feats.where(F.col("prev_close").isNotNull())
