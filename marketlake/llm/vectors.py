"""Integer vectors: components scaled and floored, packed as little-endian int32."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer components at least this large in magnitude are out of range: sums of their products need not fit 64 bits.
LIMIT = 1 << 27


def integer_vectors(df: DataFrame, vector: Column, factor: int, width: int | None = None, **carried: Column) -> DataFrame:
    """(carried columns, ints binary): ``floor(factor * x)`` of every component x as a double.

    Rows whose vector is null, has a null, non-finite or out-of-range component
    or, with ``width``, another number of components are left out.
    """
    plain = df.select(*[c.alias(n) for n, c in carried.items()], vector.cast("array<double>").alias("ints"))
    names = list(carried)
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields[:-1]], "ints binary"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(names))
            batch = batch.filter(lists.is_valid())
            lists = batch.column(len(names))
            ends = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False)  # a null component is read as NaN
            with np.errstate(over="ignore", invalid="ignore"):
                ints = np.floor(flat.astype(np.float64) * factor)
                bad = ~(np.abs(ints) < LIMIT)
            wrong = np.concatenate([[0], np.cumsum(bad)])
            keep = wrong[ends[1:]] == wrong[ends[:-1]]
            if width is not None:
                keep &= np.diff(ends) == width
            ints = np.where(bad, 0, ints).astype("<i4")
            rows = [ints[ends[k] : ends[k + 1]].tobytes() for k in np.flatnonzero(keep)]
            kept = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*[kept.column(k) for k in range(len(names))], pa.array(rows, pa.binary())], [*names, "ints"])

    return plain.mapInArrow(packed, schema)


def matrix(column: list[bytes], width: int | None = None) -> np.ndarray:
    """Packed vectors as an int64 matrix; shorter ones are filled up with zeros."""
    width = max((len(b) // 4 for b in column), default=0) if width is None else width
    return np.frombuffer(b"".join(b.ljust(4 * width, b"\0") for b in column), "<i4").reshape(len(column), width).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b`` (of unequal widths: missing components are zero)."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not width or not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    largest = float(np.abs(a).max()) * float(np.abs(b).max()) * width
    if largest < 2**53:  # every partial sum is a whole number that a double holds exactly
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T
