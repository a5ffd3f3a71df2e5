"""Substring dedup: words in windows that an earlier document also has.

A window is SIZE consecutive words of one document.  A word goes if a window
over it starts, word for word, in a document with a smaller id too; windows are
judged on the input.

Pass 1, the count-min prefilter.  Each window is counted under its anchor, the
shingle of half its size with the smallest hash in it: equal windows have equal
anchors, so an anchor's count never falls short of its windows' counts, and a
text has about one anchor for every SIZE / 4 words instead of a window at each
word.  A task's sketch holds the cells (anchor hash modulo the sketch's width)
of its chunk with the documents that fell into them; the sketches are sparse and
merged by cell in a shuffle, not broadcast, so one wide row replaces several
narrow ones and its size follows the input.  A cell with two documents is
estimated repeated; a whole text is also counted once under its 128-bit hash, so
copies of it need no windows.

Pass 2.  Documents get their repeated cells back, and only windows whose anchor
lies in one are hashed (128 bits) and grouped exactly, to the smallest document
of each.  Both passes settle what is repeated inside a chunk on the spot, so a
group that holds a third of all rows sends a row for each chunk, not for each
document.  The text is shuffled once, by doc_id and a hash of it, and that exchange serves the
second pass and the removal.

Defined cases: a null text has no words; a text of fewer words than a window is
left alone; a window that repeats only inside one document (or under one doc_id)
stays; a null doc_id is neither earlier nor later than any other, so such rows
are kept whole; an empty table gives an empty result; other columns are carried
along untouched where asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Memo, sub_batches, texts_of

SIZE = 50
#: Bits of a cell's number: the width of the sketch.
CELL_BITS = 48

CELLS_SCHEMA = "cell long, salt long, doc_id long, mark long, kind int"
WINDOWS_SCHEMA = "hi long, lo long, salt int, doc_id long, mark long, ends array<int>"
ANCHOR, KNOWN, WHOLE, COPY = range(4)

# Odd multipliers of the two rolling hashes (fixed values).
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mixed(a: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    a = (a ^ (a >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    a = (a ^ (a >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return a ^ (a >> np.uint64(32))


def _rolling(hashes: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Hash of every run of ``size`` numbers: the sum of h[i] * factor^-(i - start), modulo 2^64."""
    n = len(hashes)
    steps = np.full(n + 1, factor, np.uint64)
    back = np.full(n + 1, pow(factor, -1, 1 << 64), np.uint64)
    steps[0] = back[0] = 1
    up, down = np.cumprod(steps), np.cumprod(back)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * down[:n])])
    return _mixed((total[size:] - total[: n + 1 - size]) * up[: n + 1 - size])


def _sliding(values: np.ndarray, width: int, least: Callable) -> np.ndarray:
    """The least (or most) of every ``width`` neighbours, by doubling."""
    out, have = values, 1
    while 2 * have <= width:
        out, have = least(out[:-have], out[have:]), 2 * have
    return least(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


class _Stream:
    """The words of a chunk of documents, end to end."""

    def __init__(self, texts: list[bytes], memo: Memo, size: int):
        words = [t.split() for t in texts]
        self.size, self.half = size, size // 2
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        memo.trim()
        self.hashes = np.fromiter((h for w in words for h in map(memo.__getitem__, w)), np.uint64, self.sizes.sum())
        self.owner = np.repeat(np.arange(len(texts)), self.sizes)
        n = len(self.hashes)
        self.any = n >= size
        if self.any:
            self.inside = np.flatnonzero(self.owner[: n - size + 1] == self.owner[size - 1 :])
            self.shingles = _rolling(self.hashes, self.half, _FACTORS[0]) | np.uint64(1)
            self.least = _sliding(self.shingles, size - self.half + 1, np.minimum)

    def anchors(self) -> np.ndarray:
        """Where a shingle is the least of some window of its document."""
        span = self.size - self.half
        valid = np.zeros(len(self.shingles) + span, np.uint64)
        valid[span + self.inside] = self.least[self.inside]
        return np.flatnonzero(_sliding(valid, span + 1, np.maximum) == self.shingles)

    def cells(self) -> np.ndarray:
        return (self.shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64)

    def wholes(self) -> tuple[np.ndarray, np.ndarray]:
        """128-bit hashes of whole word sequences (with their lengths in them)."""
        out = []
        for k, factor in enumerate(_FACTORS):
            hashes = self.hashes if not k else _mixed(self.hashes)
            place = np.arange(len(hashes)) - np.repeat(self.firsts, self.sizes)
            powers = np.cumprod(np.full(int(self.sizes.max(initial=0)) + 1, factor, np.uint64))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[place])])
            out.append(_mixed(total[self.firsts + self.sizes] - total[self.firsts] + self.sizes.astype(np.uint64)))
        return out[0].view(np.int64), out[1].view(np.int64)


def _firsts_of(keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order rows by key and document; with the order come each row's group and whether it is of the group's smallest document."""
    order = np.lexsort([docs, *reversed(keys)])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    group = np.cumsum(new) - 1
    sorted_docs = docs[order]
    return order, group, sorted_docs == sorted_docs[new][group]


def repeated_cells(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, mark, cells, copied): each document's cells that are estimated
    repeated, and whether its whole text is in a smaller document.  ``mark`` is
    a hash of the text, so rows that share a doc_id are not taken for each other."""

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(xxhash.xxh64_intdigest)
        for batch in sub_batches(batches):
            named = batch.filter(batch.column(0).is_valid())
            ids, marks = (named.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 2))
            stream = _Stream(texts_of(named.column(1)), memo, size)
            if not stream.any:
                continue
            lo, hi = stream.wholes()
            long = np.flatnonzero(stream.sizes >= size)
            order, group, first = _firsts_of([lo[long], hi[long]], ids[long])
            at = long[order]
            keep = np.concatenate([[True], np.diff(group) > 0])[: len(at)] & first
            own = at[keep]
            copied = at[~first]
            anchors = stream.anchors()
            owner = stream.owner[anchors]
            alone = np.isin(owner, copied, invert=True)
            pairs = np.unique(np.stack([stream.cells()[anchors[alone]], owner[alone]]), axis=1)
            order, group, first = _firsts_of([pairs[0]], ids[pairs[1]])
            cells, of = pairs[0][order], pairs[1][order]
            shared = np.bincount(group, minlength=1)[group] > 1  # a cell of several documents here
            known = np.flatnonzero(shared)
            cell = np.concatenate([lo[own], lo[copied], cells[first], cells[known]])
            salt = np.concatenate([hi[own], ids[copied], np.zeros(first.sum(), np.int64), ids[of[known]]])
            row = np.concatenate([own, copied, of[first], of[known]])
            kind = np.repeat([WHOLE, COPY, ANCHOR, KNOWN], [len(own), len(copied), first.sum(), len(known)])
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(salt), pa.array(ids[row]), pa.array(marks[row]), pa.array(kind, pa.int32())], CELLS_SCHEMA_NAMES)

    sketch = docs.select("doc_id", "text", "mark").mapInArrow(sketches, CELLS_SCHEMA)
    group = Window.partitionBy("kind", "cell", "salt")
    seen = sketch.withColumns({"least": F.min("doc_id").over(group), "most": F.max("doc_id").over(group)})
    copied = (F.col("kind") == COPY) | (F.col("kind") == WHOLE) & (F.col("least") < F.col("doc_id"))
    repeated = (F.col("kind") == KNOWN) | (F.col("kind") == ANCHOR) & (F.col("least") < F.col("most"))
    return (seen.where(copied | repeated).groupBy("doc_id", "mark")
            .agg(F.collect_set(F.when(repeated, F.col("cell"))).alias("cells"), F.max(copied).alias("copied")))


CELLS_SCHEMA_NAMES = [f.split()[0] for f in CELLS_SCHEMA.split(", ")]
WINDOWS_SCHEMA_NAMES = [f.split()[0] for f in WINDOWS_SCHEMA.split(", ")]


def repeated_words(docs: DataFrame, cells: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, mark, ends): the stretches of words to remove, as flat pairs of first and past-the-last word."""

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(xxhash.xxh64_intdigest)
        for batch in sub_batches(batches):
            batch = batch.filter(batch.column(2).is_valid())
            if not batch.num_rows:
                continue
            ids, marks = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 4))
            copied = np.array(batch.column(3).to_pylist(), bool)
            stream = _Stream([b"" if c else t for c, t in zip(copied, texts_of(batch.column(1)))], memo, size)
            known = [(d, [0, 2**31 - 1]) for d in np.flatnonzero(copied)]
            hi = lo = at = np.zeros(0, np.int64)
            if stream.any:
                at = _windows(stream, batch.column(2))
                lo = _rolling(stream.hashes, size, _FACTORS[0])[at].view(np.int64)
                hi = _rolling(_mixed(stream.hashes), size, _FACTORS[1])[at].view(np.int64)
            owner = stream.owner[at]
            order, group, first = _firsts_of([hi, lo], ids[owner])
            late = order[~first]
            for d in np.unique(owner[late]):
                begin = np.sort(at[late][owner[late] == d]) - stream.firsts[d]
                known.append((d, _stretches(begin, size)))
            mine = order[first]
            asked, count = np.unique(group[first] * len(ids) + owner[mine], return_counts=True)
            places = (at - stream.firsts[owner])[mine] if len(at) else at
            lead = np.cumsum(count) - count
            ends = [_stretches(np.sort(places[a : a + n]), size) if n > 1 else [places[a], places[a] + size] for a, n in zip(lead, count)]
            settled = np.array([d for d, _ in known], np.int64)
            row = np.concatenate([owner[mine][lead], settled])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([hi[mine][lead], ids[settled]])),
                pa.array(np.concatenate([lo[mine][lead], np.zeros(len(known), np.int64)])),
                pa.array(np.repeat([0, 1], [len(asked), len(known)]), pa.int32()),
                pa.array(ids[row]), pa.array(marks[row]),
                pa.array(ends + [e for _, e in known], pa.list_(pa.int32())),
            ], WINDOWS_SCHEMA_NAMES)

    own = ["doc_id", "mark"]
    with_cells = docs.select("doc_id", "text", "mark").join(cells.hint("shuffle_hash"), own, "left").select("doc_id", "text", "cells", "copied", "mark")
    asked = with_cells.mapInArrow(candidates, WINDOWS_SCHEMA)
    least = F.min("doc_id").over(Window.partitionBy("salt", "hi", "lo"))
    late = asked.withColumn("least", least).where((F.col("salt") == 1) | (F.col("least") < F.col("doc_id")))
    return late.groupBy(*own).agg(F.flatten(F.collect_list("ends")).alias("ends"))


def _windows(stream: _Stream, cells: pa.Array) -> np.ndarray:
    """Starts of the windows whose anchor is in a repeated cell of their document."""
    counts = np.array([len(c) for c in cells.to_pylist()], np.int64)
    listed = cells.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    pairs = np.stack([np.repeat(np.arange(len(counts)), counts), listed])
    wanted, numbers = np.unique(listed, return_inverse=True)
    if not len(wanted):
        return np.zeros(0, np.int64)
    own = stream.cells()
    place = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
    maybe = np.flatnonzero(wanted[place] == own)
    codes = stream.owner[maybe] * len(wanted) + place[maybe]
    repeated = maybe[np.isin(codes, pairs[0] * len(wanted) + numbers)]
    held = np.full(len(stream.shingles), ~np.uint64(0))
    held[repeated] = stream.shingles[repeated]
    least = _sliding(held, stream.size - stream.half + 1, np.minimum)
    return stream.inside[(least == stream.least)[stream.inside]]


def _stretches(begin: np.ndarray, size: int) -> list[int]:
    """Sorted window starts as merged pairs of first and past-the-last word."""
    cut = np.flatnonzero(np.diff(begin) > size)
    first, last = np.concatenate([begin[:1], begin[cut + 1]]), np.concatenate([begin[cut], begin[-1:]]) + size
    return np.stack([first, last], axis=1).ravel().tolist()


def digest_columns(texts: list[bytes], words: list[list[bytes]], kept: list[list[bytes]]) -> dict[str, pa.Array]:
    return {"n_words": pa.array([len(w) for w in words], pa.int64()), "n_removed": pa.array([len(w) - len(k) for w, k in zip(words, kept)], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for k in kept], pa.string())}


DIGEST_SCHEMA = "n_words long, n_removed long, kept_sha256 string"


def kept_columns(texts: list[bytes], words: list[list[bytes]], kept: list[list[bytes]]) -> dict[str, pa.Array]:
    """The text as it was where nothing goes, else its kept words joined by one space."""
    left = [t if len(w) == len(k) else b" ".join(k) for t, w, k in zip(texts, words, kept)]
    return {"n_removed": pa.array([len(w) - len(k) for w, k in zip(words, kept)], pa.int64()), "kept_text": pa.array([t.decode() for t in left], pa.string())}


KEPT_SCHEMA = "n_removed long, kept_text string"


def remove_repeats(docs: DataFrame, columns=kept_columns, schema: str = KEPT_SCHEMA, size: int = SIZE, id_col: str = "doc_id",
                   text_col: str = "text", carry: bool = False) -> DataFrame:
    """A row for each document: doc_id, what ``columns(texts, words, kept)``
    makes of it and, with ``carry``, the whole input row as the struct ``row``."""
    carried = F.struct(*[docs[c] for c in docs.columns]) if carry else F.lit(None).cast("int")
    plain = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), carried.alias("row"))
    plain = plain.withColumn("mark", F.xxhash64("text"))
    bare = plain.select("doc_id", "text", "mark")
    ends = repeated_words(bare, repeated_cells(bare, size), size)
    kind = plain.schema["row"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            texts, ends = texts_of(batch.column(1)), batch.column(2).to_pylist()
            words = [t.split() for t in texts]
            kept = [_without(w, e) if e else w for w, e in zip(words, ends)]
            made = columns(texts, words, kept)
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.values(), *([batch.column(3)] if carry else [])], ["doc_id", *made, *(["row"] if carry else [])])

    joined = (plain if carry else bare).join(ends.hint("shuffle_hash"), ["doc_id", "mark"], "left").select("doc_id", "text", "ends", *(["row"] if carry else []))
    return joined.mapInArrow(rows, f"doc_id long, {schema}" + (f", row {kind}" if carry else ""))


def _without(words: list[bytes], ends: list[int]) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    pairs = np.minimum(np.array(ends).reshape(-1, 2), len(words))
    np.add.at(change, pairs[:, 0], 1)
    np.add.at(change, pairs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
