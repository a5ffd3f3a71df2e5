"""Tables written as versions, so that no failure loses rows.

Every write is a new version: a folder of its own, written by Spark's Parquet
writer and never changed after.  A small table beside the data, ``versions``,
has a row for each partition that a version holds or empties; it is appended to
by one task when the version's data are complete.  Readers take, for each
partition, the newest version with such a row, and read those folders by a plain
partitioned scan:

    <path>/data/version=<name>/[<column>=<value>/]part-*.parquet
    <path>/versions/part-*.parquet        number, name, part, filled
    <path>/counts/part-*.parquet          name, metric, value

A run that dies before its rows are in ``versions`` has changed nothing for any
reader; nothing is moved, renamed or deleted, and nothing has to be recovered.
The first run is told by the path that is not there alone: a table that cannot be
read fails the run.  One writer at a time, many readers.  ``superseded`` names
the folders that no reader takes any more, for the store's clean-up.

A version may carry counts over its rows (rows that fail a test, say), taken
while they are written and kept in ``counts``; ``counted`` sums them over what
readers take now.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.layout import bloom_options, clustered

LOG_SCHEMA = "number long, name string, part string, filled boolean"
COUNTS_SCHEMA = "name string, metric string, value long"
#: Stands for the whole of a table: a version with this row replaces all partitions.
WHOLE = "*"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
_PLAIN = re.compile(r"[\w.-]*")


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    return _beside(spark, f"{path}/versions", LOG_SCHEMA)


def _beside(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A small table beside the data, or None where it has not been begun."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a version of the table has been completed."""
    return _log(spark, path) is not None


def _newest(log: DataFrame) -> DataFrame:
    """(part, name, filled): the newest version of each partition since the last whole one."""
    last = log.where(F.col("part") == WHOLE).agg(F.max("number")).scalar()
    since = log.where((F.col("part") != WHOLE) & (F.col("number") >= F.coalesce(last, F.lit(0))))
    return since.groupBy("part").agg(F.max_by(F.struct("name", "filled"), "number").alias("v")).select("part", "v.name", "v.filled")


def _part(column: str | None):
    """A row's folder below its version."""
    if column is None:
        return F.lit("")
    return F.concat(F.lit(f"{column}="), F.coalesce(F.col(column).cast("string"), F.lit(NULL_PART)))


def publish(df: DataFrame, path: str, partition_col: str | None = None, cluster_col: str | None = None, touched: DataFrame | None = None, counts: Mapping[str, Column] | None = None) -> None:
    """Write ``df`` as the table or, with ``touched`` (a column of partition
    values), as those partitions of it and the ones that ``df`` has rows in: a
    touched partition without rows is emptied.  ``df`` may read the table itself.

    ``counts`` (aggregates that count rows) are observed in the stage that writes
    the rows, where a task that is run again counts once, and kept for ``counted``.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    data = f"{path}/data/version={name}"
    seen = Observation() if counts else None

    def watch(rows: DataFrame) -> DataFrame:
        return rows if seen is None else rows.observe(seen, *[c.cast("long").alias(f"c{i}") for i, c in enumerate(counts.values())])

    if cluster_col:
        # Rows of a partition value go to one task (AQE splits a heavy one),
        # so a partition is one file, not one for each upstream task.
        df = clustered(df, partition_col, [cluster_col], watch)
    else:
        df = watch(df)
    writer = df.write.options(**bloom_options([cluster_col] if cluster_col else []))
    (writer.partitionBy(partition_col) if partition_col else writer).parquet(data)
    if seen is not None:
        # Before the log's rows: a version that readers take has its counts.
        values = seen.get
        kept = [(name, metric, values.get(f"c{i}") or 0) for i, metric in enumerate(counts)]
        spark.createDataFrame(kept, COUNTS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/counts")
    written = spark.read.schema(df.schema).parquet(data)
    filled = written.select(_part(partition_col).alias("part")).distinct() if partition_col else spark.createDataFrame([("",)], "part string")
    rows = filled.withColumn("filled", F.lit(True))
    if touched is None:
        rows = rows.unionByName(spark.createDataFrame([(WHOLE, True)], "part string, filled boolean"))
    elif partition_col:
        named = touched.select(_part(partition_col).alias("part")).distinct()
        rows = rows.unionByName(named.join(filled, "part", "left_anti").withColumn("filled", F.lit(False)))
    log = _log(spark, path)
    number = 1 if log is None else (log.agg(F.max("number")).first()[0] or 0) + 1
    # One task, so one file: it is there whole or not at all.
    rows.select(F.lit(number).cast("long").alias("number"), F.lit(name).alias("name"), "part", "filled").coalesce(1).write.mode("append").parquet(f"{path}/versions")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version of every partition, columns in the order of ``schema``.

    The folder names, one for each partition of the table, go through the driver
    as those of any partitioned table do."""
    log = _log(spark, path)
    if log is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    return _folders(spark, path, _newest(log).where("filled").collect(), schema)


def _folders(spark: SparkSession, path: str, live: list, schema: T.StructType) -> DataFrame:
    """The rows of some (part, name) of a table."""
    for r in live:
        if not _PLAIN.fullmatch(r.part.partition("=")[2]):
            raise ValueError(f"a partition value that is no plain word: {r.part}")
    folders = [f"{path}/data/version={r.name}" + (f"/{r.part}" if r.part else "") for r in live]
    if not folders:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)
    return df.select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def counted(spark: SparkSession, path: str, schema: T.StructType, counts: Mapping[str, Column]) -> dict[str, int]:
    """``counts`` over the table as ``read`` gives it, from what was kept when it
    was written.

    A version that is still read whole gives its counts, and one whose counts are
    all nought gives nought for any of its partitions.  Rows are read again only
    where neither holds: of versions that were replaced in part and have failing
    rows, or were written without these counts.
    """
    log = _log(spark, path)
    if log is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    filled = log.where(F.col("filled") & (F.col("part") != WHOLE))
    live = _newest(log).where("filled").join(filled.groupBy("name").agg(F.count_distinct("part").alias("parts")), "name").collect()
    left, parts, known = Counter(r.name for r in live), {r.name: r.parts for r in live}, {}
    kept = _beside(spark, f"{path}/counts", COUNTS_SCHEMA)
    if kept is not None:
        names = _newest(log).where("filled").select("name").distinct()
        for r in kept.where(F.col("metric").isin(list(counts))).join(names, "name", "left_semi").collect():
            known.setdefault(r.name, {})[r.metric] = r.value
    again = {n for n in left if known.get(n, {}).keys() != counts.keys() or any(known[n].values()) and left[n] < parts[n]}
    total = {m: sum(known[n][m] for n in left if n not in again) for m in counts}
    if again:
        rows = _folders(spark, path, [r for r in live if r.name in again], schema)
        found = rows.agg(*[c.cast("long").alias(f"c{i}") for i, c in enumerate(counts.values())]).first()
        total = {m: n + (found[i] or 0) for i, (m, n) in enumerate(total.items())}
    return total


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """(folder): folders of completed versions that readers no longer take."""
    log = _log(spark, path)
    if log is None:
        return spark.createDataFrame([], "folder string")
    live = _newest(log).where("filled").select("part", "name")
    old = log.where(F.col("filled") & (F.col("part") != WHOLE)).select("part", "name").join(live, ["part", "name"], "left_anti")
    return old.select(F.concat_ws("/", F.concat(F.lit("data/version="), "name"), F.nullif("part", F.lit(""))).alias("folder"))
