"""Centroid clustering with an equal-average equal-variance search.

Vectors are integers (vectors.py), and so are centroids, distances and sums, so
every round is exact and does not depend on how rows are dealt out.  The search
for a vector's nearest centroid goes by the component sums: centroids are sorted
by theirs, the scan starts where the vector's own would stand and goes outward,
the nearer neighbour first.  With D components, sums S, and U = D * sum(x^2) - S^2,

    D * distance >= (Sx - Sc)^2                               (equal average)
    D * distance >= (Sx - Sc)^2 + (sqrt Ux - sqrt Uc)^2       (equal variance)

so the first inequality ends the scan and the second skips a centroid.  Both are
taken in doubles with a margin on the safe side; a centroid that passes is
measured in whole numbers, and a tie goes to the smaller number.

A round is one scan of the written integer vectors: each task adds up its rows
by cluster and sends a row for each cluster and component, whatever its size.
The driver holds the centroids only.

Defined cases: rows whose vector is null, has another number of components, or
a null, non-finite or out-of-range component (2^27 and more after scaling) are
not kept; a null id is kept and clustered, but is the last choice for a start;
repeated rows count each, and of rows with one id the lesser vector starts
first; fewer kept vectors than clusters make fewer centroids; an empty table
gives an empty result; other columns are not looked at.  A sum of distances
that a long cannot hold is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .vectors import integer_vectors, matrix

STATS_SCHEMA = "cluster int, place int, value long"
RESULT_SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
#: Rows searched at once inside a task.
ROWS = 8192
#: Places of a cluster's row count and summed distance, beside those of its components.
COUNT, DISTANCE = -1, -2


class Centroids:
    """Numbered integer centroids, searched by equal average and equal variance."""

    def __init__(self, rows: list[list[int]]):
        found = np.array(rows, np.int64)
        sums = found.sum(axis=1)
        self.numbers = np.lexsort([np.arange(len(rows)), sums])
        self.rows, self.sums = found[self.numbers], sums[self.numbers].astype(np.float64)
        self.deviations, self.slack = _deviations(self.rows)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of every row's nearest centroid, and how many distances were measured."""
        width, total, measured = x.shape[1], len(self.rows), 0
        sums = x.sum(axis=1).astype(np.float64)
        deviations, slack = _deviations(x)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(len(x), np.iinfo(np.int64).max)
        number = np.full(len(x), total, np.int64)
        live = np.arange(len(x))
        padded = np.concatenate([[-np.inf], self.sums, [np.inf]])
        for _ in range(total):
            below, above = sums[live] - padded[left[live] + 1], padded[right[live] + 1] - sums[live]
            down = below <= above
            at, gap = np.where(down, left[live], right[live]), np.where(down, below, above)
            bound = width * best[live].astype(np.float64) * (1 + 1e-9) + 1
            go = gap * gap * (1 - 1e-9) <= bound  # every centroid left is at least as far away by its sum
            live, at, gap, bound, down = live[go], at[go], gap[go], bound[go], down[go]
            if not len(live):
                break
            apart = np.maximum(np.abs(deviations[live] - self.deviations[at]) - slack[live] - self.slack[at], 0)
            near = np.flatnonzero((gap * gap + apart * apart) * (1 - 1e-9) <= bound)
            rows, of = live[near], at[near]
            distance = np.square(x[rows] - self.rows[of]).sum(axis=1)
            measured += len(rows)
            name = self.numbers[of]
            better = (distance < best[rows]) | (distance == best[rows]) & (name < number[rows])
            best[rows[better]], number[rows[better]] = distance[better], name[better]
            left[live[down]] -= 1
            right[live[~down]] += 1
        return number, best, measured


def _deviations(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(D * sum(x^2) - S^2) and a bound on its rounding error."""
    squares = x.shape[1] * np.square(x).sum(axis=1).astype(np.float64)
    sums = x.sum(axis=1).astype(np.float64)
    return np.sqrt(np.maximum(squares - sums * sums, 0)), np.sqrt(squares) * 2.0**-24


def _searched(batches: Iterator[pa.RecordBatch], centroids: Centroids, width: int):
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            x = matrix(part.column(1).to_pylist(), width)
            yield part, x, *centroids.nearest(x)[:2]


def round_sums(kept: DataFrame, rows: list[list[int]]) -> dict[tuple[int, int], int]:
    """By (cluster, place): sums of the components, the row count and the summed distance."""
    width = len(rows[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(rows), width + 2), np.int64)
        for _, x, number, distance in _searched(batches, Centroids(rows), width):
            order = np.argsort(number, kind="stable")
            found, first = np.unique(number[order], return_index=True)
            total[found, :width] += np.add.reduceat(x[order], first, axis=0)
            total[found, width] += np.bincount(number, minlength=len(rows))[found]
            total[found, width + 1] += np.add.reduceat(distance[order], first)
        used = np.flatnonzero(total[:, width])
        places = np.concatenate([np.arange(width), [COUNT, DISTANCE]])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, width + 2), pa.int32()), pa.array(np.tile(places, len(used)), pa.int32()),
                                          pa.array(total[used].ravel())], ["cluster", "place", "value"])

    summed = kept.mapInArrow(sums, STATS_SCHEMA).groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    return {(r.cluster, r.place): int(r.value) for r in summed.collect()}  # clusters x (components + 2) rows


def cluster(df: DataFrame, clusters: int = 8, rounds: int = 10, seed: int = 3, factor: int = 1024, width: int = 64, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """A row for each kept vector: vec_id, cluster, distance (squared), its
    cluster's and all distances summed, and a hash of the final centroid."""
    spark = df.sparkSession
    path = scratch_path(spark, "integer-vectors")
    integer_vectors(df, df[vector_col], factor, width, vec_id=df[id_col].cast("long")).write.parquet(path)
    kept = spark.read.schema("vec_id long, ints binary").parquet(path)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = kept.orderBy(mark.asc_nulls_last(), "ints").limit(clusters).collect()
    if not starts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    rows = matrix([bytes(r.ints) for r in starts], width).tolist()
    for _ in range(rounds):
        sums = round_sums(kept, rows)
        rows = [[sums[k, p] // sums[k, COUNT] for p in range(width)] if (k, COUNT) in sums else row for k, row in enumerate(rows)]
    sums = round_sums(kept, rows)

    def fits(n: int) -> int | None:
        return n if n < 1 << 63 else None

    own = [fits(sums.get((k, DISTANCE), 0)) for k in range(len(rows))]
    every = fits(sum(sums.get((k, DISTANCE), 0) for k in range(len(rows))))
    marks = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in rows]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, number, distance in _searched(batches, Centroids(rows), width):
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(number, pa.int32()), pa.array(distance), pa.array([own[k] for k in number], pa.int64()),
                pa.array([every] * len(number), pa.int64()), pa.array([marks[k] for k in number]),
            ], [f.split()[0] for f in RESULT_SCHEMA.split(", ")])

    return kept.mapInArrow(assigned, RESULT_SCHEMA)
