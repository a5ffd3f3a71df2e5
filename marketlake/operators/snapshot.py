"""Type-2 history of company profiles (I-4)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.columns import ntz_lit
from marketlake.operators import versions

# The columns whose change opens a new profile version.
PROFILE_CHECK_COLS = ["company_name", "exchange", "industry", "country", "market_cap",
                      "ipo_date", "logo_url", "web_url", "sector"]

META = ["valid_from", "valid_to", "is_current"]


def scd2_apply(history: DataFrame | None, current: DataFrame, key: str, check_cols: Sequence[str],
               run_ts: dt.datetime) -> DataFrame:
    """Apply one snapshot run and return the full new history: the closed
    versions untouched, and ``scd2_changes`` of the open ones."""
    if history is None:
        return scd2_changes(None, current, key, check_cols, run_ts)
    closed = history.where(~F.col("is_current")).select(*current.columns, *META)
    return closed.unionByName(scd2_changes(history.where(F.col("is_current")), current, key, check_cols, run_ts))


def scd2_changes(open_: DataFrame | None, current: DataFrame, key: str, check_cols: Sequence[str],
                 run_ts: dt.datetime) -> DataFrame:
    """The open versions after a run, and those that the run closes.

    One full outer join of the open versions with the current rows on the
    key (each side has one row per key) decides per key: unchanged -> keep
    the open row; changed (NULL-safe compare over ``check_cols``) -> close it
    at ``run_ts`` and open the new version; new key -> open it; vanished key
    -> leave it open.
    """
    run = ntz_lit(run_ts)
    data_cols = current.columns
    if open_ is None:
        return current.select(*data_cols, run.alias("valid_from"),
                              F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                              F.lit(True).alias("is_current"))
    h = open_.select(*[F.col(c).alias(f"h_{c}") for c in data_cols + META])
    c = current.select(*[F.col(x).alias(f"c_{x}") for x in data_cols])
    j = h.join(c, F.col(f"h_{key}") == F.col(f"c_{key}"), "full_outer")
    has_h, has_c = F.col(f"h_{key}").isNotNull(), F.col(f"c_{key}").isNotNull()
    same = None
    for col in check_cols:
        e = F.col(f"h_{col}").eqNullSafe(F.col(f"c_{col}"))
        same = e if same is None else (same & e)
    changed = has_h & has_c & ~same

    def version(prefix, vfrom, vto, cur):
        return F.struct(*[F.col(f"{prefix}{x}").alias(x) for x in data_cols],
                        vfrom.alias("valid_from"), vto.alias("valid_to"), cur.alias("is_current"))

    null_ts = F.lit(None).cast("timestamp_ntz")
    keep_old = version("h_", F.col("h_valid_from"), F.col("h_valid_to"), F.col("h_is_current"))
    close_old = version("h_", F.col("h_valid_from"), run, F.lit(False))
    open_new = version("c_", run, null_ts, F.lit(True))
    versions = (F.when(changed, F.array(close_old, open_new))
                .when(has_h, F.array(keep_old))
                .otherwise(F.array(open_new)))
    return j.select(F.explode(versions).alias("v")).select("v.*")


#: Partition of the change log: the run that wrote the change.
RUN = "_run"


def _changes_schema(data_schema: T.StructType) -> T.StructType:
    return T.StructType([*data_schema.fields, T.StructField("valid_from", T.TimestampNTZType()), T.StructField(RUN, T.StringType())])


def read_snapshot(spark: SparkSession, path: str, data_schema: T.StructType, key: str = "symbol", open_only: bool = False) -> DataFrame:
    """The history written by ``run_snapshot``: a change is valid until the next one of its key."""
    until = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    log = versions.read(spark, path, _changes_schema(data_schema)).withColumn("valid_to", until)
    df = log.withColumn("is_current", F.col("valid_to").isNull()).select(*data_schema.fieldNames(), *META)
    return df.where("is_current") if open_only else df


def run_snapshot(spark: SparkSession, path: str, current: DataFrame, key: str, check_cols: Sequence[str], run_ts: dt.datetime) -> None:
    """One run over the table at ``path``, a log of changes that is only added to.

    A row of ``current`` is a change if its key has none yet, or if the key's
    newest change before this run differs in one of ``check_cols`` (NULL-safe).
    A key that vanished has no change, so it stays open.  No earlier row is
    rewritten, since the end of validity is not stored.  A run that is
    repeated replaces its own changes.
    """
    schema = current.schema
    changes = current
    if versions.exists(spark, path):
        log = versions.read(spark, path, _changes_schema(schema)).where(F.col("valid_from") < ntz_lit(run_ts))
        known = log.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*check_cols), "valid_from").alias("__was"))
        is_new = F.col("__was").isNull()
        differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col("__was").getField(c)) for c in check_cols])
        changes = current.join(known, F.col(key).eqNullSafe(F.col("__key")), "left").where(is_new | differs).select(*current.columns)
    run = f"{run_ts:%Y%m%dT%H%M%S%f}"
    own = changes.withColumns({"valid_from": ntz_lit(run_ts), RUN: F.lit(run)})
    versions.publish(own, path, RUN, touched=spark.createDataFrame([(run,)], f"{RUN} string"))
