"""Raw table readers and ingest windows (S-1, S-2, S-11)."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.sources.drift import read_reconciled
from marketlake.sources.universe import default_seed

RAW_CANDLES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trading_date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("_loaded_at", T.TimestampType()),
])

RAW_PROFILES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("logo_url", T.StringType()),
    T.StructField("ipo_date", T.StringType()),
    T.StructField("web_url", T.StringType()),
    T.StructField("_loaded_at", T.TimestampType()),
])

RAW_NEWS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("datetime", T.TimestampType()),
    T.StructField("headline", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("image", T.StringType()),
    T.StructField("_loaded_at", T.TimestampType()),
])

RAW_FINANCIALS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("pe_ratio", T.DoubleType()),
    T.StructField("pb_ratio", T.DoubleType()),
    T.StructField("eps_ttm", T.DoubleType()),
    T.StructField("dividend_yield", T.DoubleType()),
    T.StructField("beta", T.DoubleType()),
    T.StructField("week_52_high", T.DoubleType()),
    T.StructField("week_52_low", T.DoubleType()),
    T.StructField("52_week_high", T.DoubleType()),
    T.StructField("52_week_low", T.DoubleType()),
    T.StructField("market_cap", T.DoubleType()),
    T.StructField("_loaded_at", T.TimestampType()),
])

# Hive partition columns per raw table (values are zero-padded in paths and
# read back as integers).
PARTITIONS = {
    "candles": ["year", "month", "day"],
    "company_profiles": ["year", "month"],
    "company_news": ["year", "week"],
    "company_financials": ["year", "month"],
}

SCHEMAS = {
    "candles": RAW_CANDLES,
    "company_profiles": RAW_PROFILES,
    "company_news": RAW_NEWS,
    "company_financials": RAW_FINANCIALS,
}

SEED_SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("sector", T.StringType())])


def conform_numeric(df: DataFrame, table: str) -> DataFrame:
    """Cast numeric columns to the declared raw type before landing.

    A batch may carry an integer ``volume`` or ``market_cap`` where another
    batch has fractions; Parquet readers refuse to read INT64 files as
    DOUBLE, so every landed file must already use the declared type.
    """
    declared = {f.name: f.dataType for f in SCHEMAS.get(table, T.StructType([])).fields}
    cols = []
    for f in df.schema.fields:
        target = declared.get(f.name)
        if (isinstance(target, T.DoubleType) and isinstance(f.dataType, T.NumericType)
                and not isinstance(f.dataType, T.DoubleType)):
            cols.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def with_partition_fields(schema: T.StructType, table: str) -> T.StructType:
    fields = list(schema.fields) + [T.StructField(p, T.IntegerType()) for p in PARTITIONS[table]]
    return T.StructType(fields)


def read_raw(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None,
             partition_filter=None, missing_ok: bool = False, reconcile: bool = False) -> DataFrame:
    """S-1: a raw table with its partition columns, under an explicit schema.

    The declared schema (not inference or mergeSchema) fixes the types.  Our own
    writers land every file in them; ``reconcile`` also reads files that others
    landed with whole-number columns as INT64 (sources/drift.py).  A
    ``partition_filter`` on year/month/day prunes directories; never prune
    candles by trading date through the path (a run writes 7 days of bars
    under its run day) — filter the column instead.  ``missing_ok`` reads a
    table that has not been landed yet as empty.
    """
    full = with_partition_fields(schema or SCHEMAS[table], table)
    path = f"{root}/{table}"
    try:
        if reconcile:
            return read_reconciled(spark, path, full, partition_filter)
        df = spark.read.schema(full).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if not (missing_ok and e.getCondition() == "PATH_NOT_FOUND"):
            raise
        # nothing landed yet for this table: an empty table of the declared schema
        df = spark.createDataFrame([], full)
    df = df.select(*[F.col(f"`{c}`") for c in full.fieldNames()])  # not the run day of profile objects
    return df.where(partition_filter) if partition_filter is not None else df


def read_seed(spark: SparkSession, path: str | None) -> DataFrame:
    """S-2: the sector seed CSV (header row, explicit schema); without a path the shipped one."""
    if path is None:
        return default_seed(spark)
    return spark.read.schema(SEED_SCHEMA).option("header", True).csv(path)


# Look-back of each ingest job in days.
WINDOW_DAYS = {"backfill": 365, "daily": 7, "weekly_news": 7}


def ingest_window(df: DataFrame, as_of: dt.date, mode: str, col: str = "trading_date") -> DataFrame:
    """S-11: rows inside a job's date range, both bounds inclusive.

    backfill = [as_of - 365, as_of]; daily and weekly news = [as_of - 7,
    as_of]; monthly = the as_of day only (point-in-time snapshot).
    """
    end = F.lit(as_of).cast("date")
    c = F.col(col).cast("date")
    if mode == "monthly":
        return df.where(c == end)
    if mode not in WINDOW_DAYS:
        raise ValueError(f"unknown ingest mode {mode!r}")
    return df.where(c.between(F.date_sub(end, WINDOW_DAYS[mode]), end))
