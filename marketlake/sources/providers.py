"""Second price provider and source precedence (S-8..S-10)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.columns import normalize_symbol


def provider_ticker(symbol_col: str = "symbol"):
    """The fallback provider spells share classes with a dash (request only)."""
    return F.replace(F.col(symbol_col), F.lit("."), F.lit("-"))


def normalize_fallback_candles(bars: DataFrame, loaded_at) -> DataFrame:
    """S-8: flat daily bars (Date, Open, High, Low, Close, Volume) -> candle
    shape.  Missing prices become 0.0 and missing volume 0 (volume truncated
    to an integer), so a filled close passes later ``close is not null``
    filters and yields NULL returns.  The stored symbol is unchanged."""
    la = loaded_at if isinstance(loaded_at, F.Column) else F.lit(loaded_at)
    return bars.select(
        F.col("symbol"),
        provider_ticker("symbol").alias("provider_ticker"),
        F.col("Date").cast("date").alias("trading_date"),
        *[F.coalesce(F.col(src).cast("double"), F.lit(0.0)).alias(dst)
          for src, dst in (("Open", "open"), ("High", "high"), ("Low", "low"), ("Close", "close"))],
        F.coalesce(F.col("Volume").cast("double"), F.lit(0.0)).cast("long").alias("volume"),
        la.alias("_loaded_at"),
    )


# Accepted provider modes (primary first, fallback second).
PROVIDER_MODES = ("auto", "primary", "fallback")


def switched_symbols(denied: DataFrame, order: DataFrame, symbol: str = "symbol") -> DataFrame:
    """(__s): the symbols from the first denied one on, in the order of
    ``order`` (``symbol``, ``place``), and the denied ones.

    A loop that gives up its primary provider at the first denial asks the
    fallback for that symbol and every later one.  As a set operation: the least
    place of a denied symbol is one scalar, and a symbol's own place is compared
    with it.  Symbols without a place are neither before nor after it."""
    refused = denied.select(normalize_symbol(symbol).alias("__s")).distinct()
    placed = order.select(normalize_symbol(symbol).alias("__s"), "place").groupBy("__s").agg(F.min("place").alias("place"))
    first = placed.join(refused, "__s", "left_semi").agg(F.min("place")).scalar()
    return placed.where(F.col("place") >= first).select("__s").unionByName(refused).distinct()


def provider_fallback(primary: DataFrame, fallback: DataFrame, denied: DataFrame, symbol: str = "symbol",
                      mode: str = "auto", order: DataFrame | None = None) -> DataFrame:
    """S-9: primary rows, plus fallback rows of the symbols the primary refuses.

    ``mode``: ``primary`` = primary only, ``fallback`` = fallback only,
    ``auto`` = primary first, fallback for the symbols in ``denied`` (column
    ``symbol``).  A symbol for which the primary has no data is not denied and
    gets no fallback rows.

    With ``order`` (``symbol``, ``place``) the switch is for good: the first
    denied symbol and all that come after it in that order get fallback rows,
    also those that the primary has rows of.  Without it the provider is
    chosen for each symbol by itself.  The joins are left to the planner and AQE
    (broadcast only when measured small).
    """
    mode = mode.strip().lower()
    if mode not in PROVIDER_MODES:
        raise ValueError(f"provider mode must be one of {PROVIDER_MODES}")
    if mode == "primary":
        return primary
    if mode == "fallback":
        return fallback
    switched = denied.select(normalize_symbol(symbol).alias("__s")).distinct() if order is None else switched_symbols(denied, order, symbol)
    own = normalize_symbol(F.col(symbol)) == F.col("__s")
    return primary.join(switched, own, "left_anti").unionByName(fallback.join(switched, own, "left_semi"), allowMissingColumns=True)


def concat_non_empty(frames: Iterable[DataFrame]) -> DataFrame | None:
    """S-10: union by column name; frames without columns are skipped and
    missing columns become NULL.  None when nothing is left."""
    out = None
    for f in frames:
        if f is None or not f.columns:
            continue
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out
