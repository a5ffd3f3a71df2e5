"""Physical layout of written facts (I-5, I-6).

Facts are written Hive-partitioned by day (prices, news) or month
(financials) and, inside each partition, sorted by the cluster columns so
Parquet row-group min/max statistics skip data for symbol predicates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def month_partition(df: DataFrame, date_col: str = "date_key") -> DataFrame:
    """Month granularity: add ``date_month = trunc(date_key, 'MM')``."""
    return df.withColumn("date_month", F.trunc(F.col(date_col), "month"))


def clustered(df: DataFrame, partition_col: str, cluster_cols: Sequence[str],
              watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """I-6: co-locate the rows of each partition value and sort them by the
    cluster columns within each task.

    ``REBALANCE(partition_col)`` hash-partitions by the partition value and
    lets AQE split a skewed value over several writer tasks and merge small
    ones, so a heavy day is never one straggler task and a light day is one
    file, not one file per upstream task.  ``watch`` may observe the rows after
    that exchange, in the stage that writes them.
    """
    return watch(df.hint("rebalance", partition_col)).sortWithinPartitions(partition_col, *cluster_cols)


def bloom_options(cluster_cols: Sequence[str]) -> dict[str, str]:
    """Writer options for a Bloom filter a row group on the cluster columns:
    values that fall between a group's least and greatest but are not in it are
    skipped too."""
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in cluster_cols}


def write_partitioned(df: DataFrame, path: str, partition_col: str, cluster_cols: Sequence[str] = (),
                      mode: str = "overwrite", dynamic: bool = False) -> None:
    """I-5: write ``df`` partitioned by ``partition_col`` (optionally clustered).

    ``dynamic=True`` replaces only the partitions present in ``df``.
    """
    if cluster_cols:
        df = clustered(df, partition_col, cluster_cols)
    w = df.write.mode(mode).options(**bloom_options(cluster_cols)).partitionBy(partition_col)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def read_partitioned(spark, path: str, schema) -> DataFrame:
    """Read a partitioned fact back with its declared schema, in the
    declared column order (Spark appends partition columns last)."""
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def date_range_filter(start, end, date_col: str = "date_key", month_col: str | None = None) -> F.Column:
    """Predicate for a date range on a day- or month-partitioned table.

    Month-partitioned tables prune only on the derived month column, so the
    equivalent month predicate is added next to the date predicate.
    """
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    cond = F.col(date_col).between(s, e)
    if month_col:
        cond = cond & F.col(month_col).between(F.trunc(s, "month"), F.trunc(e, "month"))
    return cond
