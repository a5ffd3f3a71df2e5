"""Hard negatives of anchors, by slot-decomposed selection.

A score is the inner product of integer vectors.  An anchor's positives are its
best rows of the same label; a positive's window holds the scores of other
labels from ``least`` to ``most`` percent of the positive's.  The windows of an
anchor overlap, so they are not searched one by one: their upper limits cut the
scores into disjoint slots, each row falls into one, and the best few of each
slot are enough.  Slots are kept by combiners, first of a block and then of all
blocks, and a window's answer is the merge of the slots from its limit down.

All anchors meet all rows in blocks.  The rows are dealt into blocks of at most
ROWS by a hash of the row, a block is held as one matrix by a task, and the
anchors stream past it, so the memory of a task does not grow with either side.
What a block sends on is a few rows for each anchor and slot.  A label that a
third of all rows have is spread over all blocks.

Defined cases: rows whose label is null, or whose vector is null or has a null,
non-finite or out-of-range component (2^27 and more after scaling) take no part;
of vectors of unequal length the missing components count as zero; a null id is
no anchor, and comes after all ids in ties; rows that share an id are rows of
their own (such an anchor's results are listed for each); a negative positive
score has no window; anchors without positives or negatives have no rows; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .vectors import integer_vectors, matrix, products

#: Rows of a block, and scores computed at once.
ROWS = 32768
SCORES = 1 << 21
#: Stands for a missing id, after all others.
LAST = (1 << 63) - 1

ROWS_SCHEMA = "row long, id long, label string, anchor boolean, ints binary"
FOUND_SCHEMA = "anchor long, slot int, score long, id long, row long"


def _best(order: list[np.ndarray], keys: list[np.ndarray], count: int) -> np.ndarray:
    """Places of the first ``count`` rows of every key, rows ordered by ``order`` within it."""
    at = np.lexsort([*reversed(order), *reversed(keys)])
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = np.logical_or.reduce([k[at][1:] != k[at][:-1] for k in keys])
    first = np.flatnonzero(new)
    rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    return at[rank < count]


def positives_of(block, anchors, count: int):
    """The best ``count`` rows of the same label in a block, other than the anchor itself."""
    rows, ids, labels, x = block
    own, anchor_labels, a, _ = anchors
    for label in np.unique(anchor_labels):
        mine, theirs = np.flatnonzero(anchor_labels == label), np.flatnonzero(labels == label)
        if not len(theirs):
            continue
        scores = products(a[mine], x[theirs])
        itself = rows[theirs][None, :] == own[mine][:, None]
        scores = np.where(itself, np.iinfo(np.int64).min, scores)
        cut = np.partition(scores, -min(count, len(theirs)), axis=1)[:, -min(count, len(theirs))]
        who, what = np.nonzero((scores >= cut[:, None]) & ~itself)
        score = scores[who, what]
        at = _best([-score, ids[theirs[what]], rows[theirs[what]]], [who], count)
        yield own[mine[who[at]]], np.zeros(len(at), np.int32), score[at], ids[theirs[what[at]]], rows[theirs[what[at]]]


def slots_of(block, anchors, count: int, least: int, most: int):
    """The best ``count`` rows of other labels in every slot of a block.

    A slot's number is that of the windows whose upper limit is at or above the
    score, so a window with k windows of a higher or equal limit merges the
    slots from number k + 1 on.
    """
    rows, ids, labels, x = block
    own, anchor_labels, a, limits = anchors
    widest = max((len(p) for p in limits), default=0)
    if not widest:
        return
    upper = np.full((len(own), widest), np.iinfo(np.int64).min)
    lowest = np.full(len(own), np.iinfo(np.int64).max)
    for k, found in enumerate(limits):
        for j, score in enumerate(found):
            upper[k, j] = most * score // 100
            lowest[k] = min(lowest[k], -(-least * score // 100))
    scores = products(a, x)
    who, what = np.nonzero((scores <= upper.max(axis=1)[:, None]) & (scores >= lowest[:, None]) & (anchor_labels[:, None] != labels[None, :]))
    score = scores[who, what]
    slot = (score[:, None] <= upper[who]).sum(axis=1).astype(np.int32)
    at = _best([-score, ids[what], rows[what]], [who, slot], count)
    yield own[who[at]], slot[at], score[at], ids[what[at]], rows[what[at]]


def _against_blocks(rows: DataFrame, anchors: DataFrame, blocks: int, select) -> DataFrame:
    """``select(block, anchors)`` of every block and part of the anchors; anchors have the scores of their positives as ``limits``."""
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    none = F.lit(None).cast("array<long>")
    held = rows.select(block.alias("block"), F.lit(0).alias("kind"), "row", "id", "label", "ints", none.alias("limits"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "row", "id", "label", "ints", "limits")
    dealt = held.unionByName(asked).repartition(blocks, "block").sortWithinPartitions("block", "kind", "id", "row")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, block = None, [], None
        for batch in batches:
            while batch.num_rows:
                numbers, kinds = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                if numbers[0] != number:
                    number, parts, block = numbers[0], [], None
                same = (numbers == number) & (kinds == kinds[0])
                n = batch.num_rows if same.all() else int(np.argmin(same))
                part, batch = batch.slice(0, n), batch.slice(n)
                if kinds[0] == 0:
                    parts.append(part)
                    continue
                if block is None and parts:
                    table = pa.Table.from_batches(parts)
                    block = (table["row"].to_numpy(), table["id"].to_numpy(), np.array(table["label"].to_pylist(), object), matrix(table["ints"].to_pylist()))
                    parts = []
                if block is None:
                    continue
                step = max(1, SCORES // len(block[0]))
                for begin in range(0, n, step):
                    some = part.slice(begin, step)
                    anchors = (some.column(2).to_numpy(), np.array(some.column(4).to_pylist(), object), matrix(some.column(5).to_pylist()), some.column(6).to_pylist())
                    for made in select(block, anchors):
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], [f.split()[0] for f in FOUND_SCHEMA.split(", ")])

    return dealt.mapInArrow(found, FOUND_SCHEMA)


def _first(found: DataFrame, count: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(df: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, factor: int = 256,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for every anchor and each of its positives the first ``negatives`` rows of
    other labels in the positive's window."""
    spark = df.sparkSession
    path = scratch_path(spark, "scored-rows")
    plain = integer_vectors(df.where(df[label_col].isNotNull()), df[vector_col], factor, id=df[id_col].cast("long"), label=df[label_col].cast("string"),
                            anchor=F.coalesce(anchor, F.lit(False)) & df[id_col].isNotNull())
    plain.select(F.monotonically_increasing_id().alias("row"), F.coalesce("id", F.lit(LAST)).alias("id"), "label", "anchor", "ints").write.parquet(path)
    rows = spark.read.schema(ROWS_SCHEMA).parquet(path)
    blocks = max(-(-rows.count() // ROWS), 4 * spark.sparkContext.defaultParallelism)
    anchors = rows.where("anchor")

    found = _against_blocks(rows, anchors.withColumn("limits", F.lit(None).cast("array<long>")), blocks, lambda b, a: positives_of(b, a, positives))
    best = scratch_path(spark, "positives")
    _first(found, positives, "anchor").select("anchor", "id", "row", "score").write.parquet(best)
    chosen = spark.read.schema("anchor long, id long, row long, score long").parquet(best).where("score >= 0")

    limits = chosen.groupBy("anchor").agg(F.collect_list("score").alias("limits"))  # at most ``positives`` of an anchor
    asked = anchors.join(limits.withColumnRenamed("anchor", "row"), "row")
    slots = _first(_against_blocks(rows, asked, blocks, lambda b, a: slots_of(b, a, negatives, least, most)), negatives, "anchor", "slot")

    # The slots of an anchor, merged from a window's limit down: at most ``positives`` x ``negatives`` rows meet each positive.
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    p = chosen.select("anchor", F.col("id").alias("p_id"), F.col("row").alias("p_row"), F.col("score").alias("p_score"))
    merged = slots.drop("rank", "slot").join(p, "anchor").where((wide("p_score") * least <= wide("score") * 100) & (wide("score") * 100 <= wide("p_score") * most))
    named = _first(merged, negatives, "anchor", "p_row").join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    real = lambda c: F.nullif(F.col(c), F.lit(LAST))
    return named.select("anchor_id", real("p_id").alias("positive_id"), "rank", real("id").alias("negative_id"),
                        F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score"))
