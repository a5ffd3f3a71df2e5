"""Symbol universe (S-3)."""

from __future__ import annotations

import csv
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.columns import normalize_symbol

#: The seed that ships with the package: the universe of symbols and their sectors.
SEED_FILE = Path(__file__).parent.parent / "data" / "sector_seed.csv"


def shipped_seed() -> list[tuple[str, str]]:
    """(symbol, sector) pairs of the shipped seed."""
    with SEED_FILE.open(newline="") as lines:
        return [(row["symbol"], row["sector"]) for row in csv.DictReader(lines)]


def parse_symbol_list(value: str | Iterable[str] | None) -> list[str]:
    """Override list: comma-separated or iterable; blanks dropped; empty ->
    the default universe."""
    if value is None:
        return [symbol for symbol, _ in shipped_seed()]
    items = value.split(",") if isinstance(value, str) else list(value)
    cleaned = [s.strip() for s in items if s and s.strip()]
    return cleaned or parse_symbol_list(None)


def default_seed(spark: SparkSession) -> DataFrame:
    """The shipped seed as a table."""
    return spark.createDataFrame(shipped_seed(), "symbol string, sector string")


def symbol_order(spark: SparkSession, symbols: str | Iterable[str] | None = None) -> DataFrame:
    """(symbol, place): the symbols of the override list, or of the shipped universe, in their order."""
    return spark.createDataFrame([(s, k) for k, s in enumerate(parse_symbol_list(symbols))], "symbol string, place int")


def filter_universe(df: DataFrame, symbols: str | Iterable[str] | None = None, seed: DataFrame | None = None,
                    col: str = "symbol") -> DataFrame:
    """Keep rows whose normalised symbol is in the universe.

    With ``seed`` the universe is the seed's symbols (semi join; broadcast by
    the planner only under its size threshold); otherwise the (override or
    default) list, as ``isin``.
    """
    sym = normalize_symbol(col)
    if seed is not None:
        keys = seed.select(normalize_symbol("symbol").alias("__u")).distinct()
        return df.join(keys, sym == F.col("__u"), "left_semi")
    return df.where(sym.isin([s.upper() for s in parse_symbol_list(symbols)]))
