"""Raw tables whose files disagree on numeric types (S-1).

Batches that infer their schema write a column as INT64 when all its values are
whole and as DOUBLE when one is not, and Spark's Parquet reader takes INT64 for a
double in neither direction (INT32 and FLOAT it widens).  So files are put into
groups by what their columns can be read as, each group gets a reader of its own,
and the groups are cast to the declared types and put together.

The types come from Spark's own reader, on any store it can read: one pass over
the declared double columns names the files that can be read as declared (a file
that cannot gives no row, at its first batch); where files are left over, one more
pass over those, a column at a time, tells their other columns.  No rows are
collected, only names of files that drifted; a table without such files is read
by one plain scan.  Nothing is skipped in the reading itself: a file that is
broken, or has a type that is neither, fails the read.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE = "_metadata.file_path"


def _double_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)]


def _scan(spark: SparkSession, path: str, schema: T.StructType, where: Column | None, files: list[str] | None = None, probe: bool = False) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", path)
    df = (reader.option("ignoreCorruptFiles", True) if probe else reader).parquet(path)
    if files is not None:
        df = df.where(F.col(FILE).isin(files))  # prunes the list of files
    return df if where is None else df.where(where)


def _readable(spark: SparkSession, path: str, schema: T.StructType, columns: list[str], where: Column | None, files: list[str] | None = None) -> DataFrame:
    """(file): those whose ``columns`` can all be read as declared."""
    read = T.StructType([f for f in schema.fields if f.name in columns or not isinstance(f.dataType, T.DoubleType)])
    probed = _scan(spark, path, read, where, files, probe=True)
    # The values have to be used, or their columns would not be read.
    return probed.groupBy(F.col(FILE).alias("file")).agg(F.max(F.xxhash64(*[F.col(f"`{c}`") for c in columns])).alias("seen")).where("seen is not null").select("file")


def drifted_files(spark: SparkSession, path: str, schema: T.StructType, where: Column | None = None) -> dict[tuple[str, ...], list[str]]:
    """Files that cannot be read as declared, by the double columns for which that is so."""
    columns = _double_columns(schema)
    if not columns:
        return {}
    every = _scan(spark, path, schema, where).select(F.col(FILE).alias("file")).distinct()
    left = [r.file for r in every.join(_readable(spark, path, schema, columns, where), "file", "left_anti").collect()]
    if not left:
        return {}
    fine = reduce(DataFrame.unionByName, [_readable(spark, path, schema, [c], where, left).withColumn("column", F.lit(c)) for c in columns])
    good: dict[str, set[str]] = defaultdict(set)
    for r in fine.collect():
        good[r.file].add(r.column)
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file in sorted(left):
        groups[tuple(c for c in columns if c not in good[file])].append(file)
    return dict(groups)


def read_reconciled(spark: SparkSession, path: str, schema: T.StructType, where: Column | None = None) -> DataFrame:
    """The table at ``path`` under ``schema`` (partition columns included), INT64 columns of drifted files as doubles.

    A file without rows is in no group and adds nothing; a file that lands
    between the two passes and the read is read as declared."""
    groups = drifted_files(spark, path, schema, where)
    names = [F.col(f"`{c}`") for c in schema.fieldNames()]
    plain = _scan(spark, path, schema, where)
    if not groups:
        return plain.select(*names)
    parts = [plain.where(~F.col(FILE).isin([f for files in groups.values() for f in files])).select(*names)]
    for columns, files in groups.items():
        own = T.StructType([T.StructField(f.name, T.LongType()) if f.name in columns else f for f in schema.fields])
        parts.append(_scan(spark, path, own, where, files).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]))
    return reduce(DataFrame.unionByName, parts)
