"""Helpers shared by the operators: column selection, bounded Arrow chunks."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import islice
from sys import getsizeof

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import sf_path

#: Bytes of text handled at once inside a task (a longer document is a chunk of its own).
CHUNK_BYTES = 4 << 20


#: Bytes that a memo may take before it starts afresh; a task holds one of each kind at most.
MEMO_BYTES = 48 << 20
#: A dictionary's share of an entry.
_SLOT = 104


class Memo(dict):
    """Values found once for each key, within a bound of bytes.

    ``find(key)`` makes a missing value.  ``trim`` is called between chunks, so
    every key of a chunk stays known while the chunk is worked on: the memo holds
    ``limit`` bytes and one chunk's keys at most."""

    def __init__(self, find: Callable | None = None, limit: int | None = None):
        self.find, self.limit = find, MEMO_BYTES if limit is None else limit

    def __missing__(self, key):
        found = self[key] = self.find(key)
        return found

    def size(self) -> int:
        """Bytes held, by the mean of the oldest and the newest entries."""
        if not self:
            return 0
        some = [*islice(self.items(), 32), *islice(reversed(self.items()), 32)]
        return len(self) * (_SLOT + sum(getsizeof(k) + getsizeof(v) for k, v in some) // len(some))

    def trim(self, keep: float = 0.0) -> bool:
        """Forget everything, or all but a share of the oldest entries (frequent words come early), if the memo is beyond its bound."""
        full = self.size() > self.limit
        if full:
            kept = list(islice(self.items(), int(keep * len(self))))
            self.clear()
            self.update(kept)
        return full


@contextmanager
def collector_off() -> Iterator[None]:
    """No cyclic garbage collection for work that makes many objects and no cycles (its passes over them cost a quarter of the time)."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, name))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text, under fixed names: extra columns
    and clashing names in the input never reach an operator."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def byte_chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) of at most ``limit`` bytes of text, whole documents
    only; a null text is empty."""
    for batch in sub_batches(batches, 1, limit):
        yield batch.column(0).to_pylist(), texts_of(batch.column(1))


def sub_batches(batches: Iterable[pa.RecordBatch], text: int = 1, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in column ``text``, whole rows only."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.binary())), 0).to_pylist()
        begin = size = 0
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        if len(lengths) > begin:
            yield batch.slice(begin)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 texts of a column, a null text as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
