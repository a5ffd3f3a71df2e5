"""Rejected payloads, kept until they are mended and replayed (S-4..S-7).

A run's rejects go to a table with a partition for each run; a run that is
repeated replaces its own.  A replay takes the open rejects, lets the caller mend
them, flattens what can be read now and adds the rows to the raw tables, and only
then notes which rejects are settled, in a table of its own: a replay that dies
before is done again, and the rows it had added are loads like any others, of
which staging keeps the newest.  Nothing is collected; a reject is named by its
run, table, symbol and a hash of its payload, so copies of one are settled together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.columns import ntz_lit
from marketlake.operators import versions
from marketlake.session import scratch_path
from marketlake.sources import payloads, raw
from marketlake.sources.writers import period_values

SCHEMA = "table string, symbol string, payload string, reason string, payload_md5 string, run string"
SETTLED_SCHEMA = "run string, table string, symbol string, payload_md5 string, replay string"
NAMES = ["run", "table", "symbol", "payload_md5"]
#: How each raw table is flattened and by which period its objects are laid out.
FLATTEN = {
    "candles": (lambda df, at: payloads.flatten_candles(df, at)[0], "day"),
    "company_profiles": (payloads.flatten_profiles, "month"),
    "company_news": (payloads.flatten_news, "week"),
    "company_financials": (payloads.flatten_financials, "month"),
}


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


def _md5():
    return F.md5(F.coalesce("payload", F.lit("")))


def quarantine(rejects: DataFrame, root: str, run: str) -> None:
    """Keep a run's rejects: (table, symbol, payload, reason)."""
    spark = rejects.sparkSession
    own = rejects.select("table", F.coalesce("symbol", F.lit("")).alias("symbol"), "payload", "reason", _md5().alias("payload_md5"), F.lit(run).alias("run"))
    versions.publish(own, f"{root}/quarantine", "run", touched=spark.createDataFrame([(run,)], "run string"))


def open_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The rejects that no replay has settled."""
    if not versions.exists(spark, f"{root}/quarantine"):
        return spark.createDataFrame([], SCHEMA)
    kept = versions.read(spark, f"{root}/quarantine", _schema(spark, SCHEMA))
    if not versions.exists(spark, f"{root}/quarantine_settled"):
        return kept
    settled = versions.read(spark, f"{root}/quarantine_settled", _schema(spark, SETTLED_SCHEMA)).select(*NAMES).distinct()
    return kept.join(settled, NAMES, "left_anti").select(*kept.columns)


def replay(spark: SparkSession, root: str, raw_root: str, mend: Callable[[DataFrame], DataFrame], replay_day: dt.date,
           loaded_at: dt.datetime, name: str) -> None:
    """Mend the open rejects, land those that can be read now as objects of
    ``replay_day``, and settle them.  ``mend`` changes the column ``payload``;
    a payload that is still no good, or is null, stays open."""
    mended = scratch_path(spark, "mended")
    fixed = mend(open_rejects(spark, root)).select(*_schema(spark, SCHEMA).fieldNames()).where(F.col("payload").isNotNull())
    # A verdict depends on the payload alone: each is judged once, in its row, and only those that can be read now are kept.
    good = F.lit(False)
    for table in FLATTEN:
        good = F.when(F.col("table") == table, payloads.reject_reason(table, F.col("payload")).isNull()).otherwise(good)
    fixed.where(good).write.partitionBy("table").parquet(mended)
    taken = spark.read.schema(SCHEMA).parquet(mended)
    for table, (flatten, period) in FLATTEN.items():
        rows = raw.conform_numeric(flatten(taken.where(F.col("table") == table).select("symbol", "payload"), ntz_lit(loaded_at)), table)
        values = period_values(replay_day, period) | ({"run_day": replay_day.isoformat()} if table == "company_profiles" else {})
        # Added beside the day's other objects, whose rows they do not replace.
        rows.withColumns({k: F.lit(v) for k, v in values.items()}).write.mode("append").partitionBy(*values).parquet(f"{raw_root}/{table}")
    settled = taken.select(*NAMES).distinct()
    versions.publish(settled.withColumn("replay", F.lit(name)), f"{root}/quarantine_settled", "replay", touched=spark.createDataFrame([(name,)], "replay string"))
