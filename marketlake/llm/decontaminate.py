"""Benchmark decontamination with a positional inverted index.

The index is cut into shards of whole documents.  A shard's row holds its
documents and the postings of its terms: for each term the sorted positions of
its words in the shard, one position left free between documents, so no phrase
crosses them.  Only words that share a hash bucket with a benchmark word get
postings; the bucket set is a bitmap of fixed size.

A search sums the frequency of each benchmark term over the shards, orders the
terms of every window from the rarest, sends a window to the shards that hold
its two rarest terms (joins on the term, which read term lists only) and there
intersects their position lists, each less its offset in the window, then looks
up the other terms at the positions left.  With ``slop`` the words must follow each other in order within that
many further positions.  The documents themselves are never shuffled; a shard's
postings move once, beside the windows that may occur in it.

A shard holds at most SHARD_BYTES of text or one longer document; it gets at
most the benchmark's windows.

Defined cases: a null or empty text has no words; an item of fewer words than a
window is one window, one without words none; repeated items count once, a null
item_id is listed as an empty string; repeated document rows and null doc_ids
give a row each; an empty benchmark leaves every document clean; an empty
document table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import Memo, byte_chunks, id_text

SHARD_BYTES = 256 << 10
#: Buckets of the bitmap of benchmark words: 128 KiB whatever the benchmark's size.
TERM_BUCKETS = 1 << 20

INDEX_SCHEMA = "shard long, doc_ids array<bigint>, sizes array<int>, terms array<string>, counts array<int>, width int, positions binary"
MATCH_SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<item:string,first:int,last:int>>"

_SPACED = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def split_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: A-Z lower-cased, then runs of digits, a-z and non-ASCII characters."""
    return text.translate(_SPACED).split()


def item_windows(items: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words): the distinct windows of ``size`` consecutive words of every item."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, words = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [w.decode() for w in split_words((text or "").encode())]
                for at in range(max(1, len(found) - size + 1) if found else 0):
                    names.append(name)
                    words.append(found[at : at + size])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.list_(pa.string()))], ["item", "words"])

    named = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    return named.mapInArrow(rows, "item string, words array<string>").distinct()


def term_buckets(windows: DataFrame) -> bytes:
    """The bitmap of the windows' words: one byte for each of TERM_BUCKETS hash buckets."""
    word = windows.select(F.explode("words").alias("word"))
    found = word.select((F.crc32(F.col("word").cast("binary")) % TERM_BUCKETS).cast("int").alias("b")).distinct()
    bitmap = np.zeros(TERM_BUCKETS, np.uint8)
    bitmap[[r.b for r in found.toLocalIterator()]] = 1
    return bitmap.tobytes()


class _Terms(Memo):
    """Numbers for the words that have postings, -1 for the others."""

    def __init__(self, bitmap: bytes):
        super().__init__(self._number)
        self.bitmap, self.names = bitmap, []

    def _number(self, word: bytes) -> int:
        if not self.bitmap[zlib.crc32(word) % TERM_BUCKETS]:
            return -1
        self.names.append(word.decode())
        return len(self.names) - 1


def build_index(docs: DataFrame, path: str, bitmap: bytes, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> None:
    """Write the shards of the index to ``path``; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, number = _Terms(sent.value), TaskContext.get().partitionId() << 32
        for ids, texts in byte_chunks(batches, shard_bytes):
            if terms.trim():
                terms = _Terms(sent.value)
            words = [split_words(t) for t in texts]
            sizes = np.array([len(w) for w in words], np.int64)
            found = np.fromiter((n for w in words for n in map(terms.__getitem__, w)), np.int64, sizes.sum())
            places = np.arange(len(found)) + np.repeat(np.arange(len(sizes)), sizes)
            known = found >= 0
            found, places = found[known], places[known]
            order = np.argsort(found, kind="stable")
            distinct, counts = np.unique(found, return_counts=True)
            width = 2 if len(sizes) + sizes.sum() < 1 << 16 else 4
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([number], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([sizes.tolist()], pa.list_(pa.int32())),
                "terms": pa.array([[terms.names[n] for n in distinct]], pa.list_(pa.string())), "counts": pa.array([counts.tolist()], pa.list_(pa.int32())),
                "width": pa.array([width], pa.int32()), "positions": pa.array([places[order].astype(f"<u{width}").tobytes()], pa.binary()),
            })
            number += 1

    id_text(docs, id_col, text_col).mapInArrow(shards, INDEX_SCHEMA).write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def ordered_windows(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(item, n, terms): the terms of each window with their offsets, rarest in
    the corpus first.  A window with a word that no document has cannot occur
    and is left out."""
    listed = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    frequency = listed.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("frequency"))
    words = windows.select("item", "words", F.posexplode("words").alias("offset", "term"))
    sized = words.join(frequency, "term").groupBy("item", "words").agg(F.sort_array(F.collect_list(F.struct("frequency", "term", "offset"))).alias("terms"))
    return sized.where(F.size("terms") == F.size("words")).select("item", F.size("words").alias("n"), F.col("terms").cast("array<struct<frequency:bigint,term:string,offset:int>>"))


def shard_windows(index: DataFrame, ordered: DataFrame) -> DataFrame:
    """(shard, windows): the windows whose two rarest terms are in the shard."""
    listed = index.select("shard", F.explode("terms").alias("term"))
    names = F.array_distinct(F.transform("terms", lambda t: t.term))
    asked = ordered.select(F.struct("item", "n", F.transform("terms", lambda t: F.struct(t.term.alias("term"), t.offset.alias("offset"))).alias("terms")).alias("window"),
                           names[0].alias("term"), F.coalesce(F.get(names, F.lit(1)), names[0]).alias("second"))
    found = listed.join(asked, "term").select("shard", "window", F.col("second").alias("term"))
    return found.join(listed, ["shard", "term"], "left_semi").groupBy("shard").agg(F.collect_list("window").alias("windows"))


def phrase(postings: dict[str, np.ndarray], dense: np.ndarray, numbers: dict[str, int], terms: list[dict]) -> np.ndarray:
    """First positions of the exact phrase, from its terms in order of rarity.

    The lists of the two rarest, each less its offset, are intersected; what is
    left is few, so the other terms are looked up at those positions in the
    same postings laid out by position (``dense``, term numbers).
    """
    starts = postings[terms[0]["term"]] - terms[0]["offset"]
    starts = starts[starts >= 0]
    for t in terms[1:2]:
        have, want = postings[t["term"]], starts + t["offset"]
        at = np.minimum(np.searchsorted(have, want), len(have) - 1)
        starts = starts[have[at] == want]
    if len(starts) and len(terms) > 2:
        places = starts[:, None] + [t["offset"] for t in terms[2:]]
        found = dense[np.minimum(places, len(dense) - 1)]
        starts = starts[(found == [numbers[t["term"]] for t in terms[2:]]).all(axis=1)]
    return starts


def proximity(postings: dict[str, np.ndarray], terms: list[dict], slop: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions where the terms follow in order with at most ``slop`` other words between."""
    ordered = sorted(terms, key=lambda t: t["offset"])
    first = last = postings[ordered[0]["term"]]
    for t in ordered[1:]:
        have = postings[t["term"]]
        at = np.searchsorted(have, last, side="right")
        first, at = first[at < len(have)], at[at < len(have)]
        last = have[at]
    near = last - first < len(ordered) + slop
    return first[near], last[near]


def find_matches(index: DataFrame, found: DataFrame, slop: int = 0) -> DataFrame:
    """One row for each document of the index: its words, the words hit, the
    items with a match and the matches (first and last word, from 0)."""

    def match(shard: dict) -> list[dict]:
        sizes = np.array(shard["sizes"], np.int64)
        firsts = np.concatenate([[0], np.cumsum(sizes + 1)])
        flat = np.frombuffer(shard["positions"], f"<u{shard['width']}").astype(np.int64)
        lists = np.split(flat, np.cumsum(shard["counts"])[:-1]) if shard["counts"] else []
        postings = dict(zip(shard["terms"], lists))
        numbers = {term: k for k, term in enumerate(shard["terms"])}
        dense = np.full(firsts[-1] + 1, -1, np.int32)
        dense[flat] = np.repeat(np.arange(len(numbers), dtype=np.int32), shard["counts"])
        matches: list[list] = [[] for _ in sizes]
        change = np.zeros(firsts[-1] + 1, np.int64)
        for w in shard["windows"] or []:
            if any(t["term"] not in postings for t in w["terms"]):
                continue
            if slop:
                begin, end = proximity(postings, w["terms"], slop)
            else:
                begin = phrase(postings, dense, numbers, w["terms"])
                end = begin + w["n"] - 1
            owner = np.searchsorted(firsts, begin, side="right") - 1
            for d, a, b in zip(owner.tolist(), begin.tolist(), end.tolist()):
                if b < firsts[d] + sizes[d]:
                    matches[d].append({"item": w["item"], "first": int(a - firsts[d]), "last": int(b - firsts[d])})
                    change[a] += 1
                    change[b + 1] -= 1
        hit = np.concatenate([[0], np.cumsum(np.cumsum(change) > 0)])
        return [{"doc_id": doc_id, "n_words": int(n), "n_hit": int(hit[a + n] - hit[a]), "items": sorted({m["item"] for m in spans}),
                 "spans": sorted(spans, key=lambda m: (m["first"], m["last"], m["item"]))}
                for doc_id, n, a, spans in zip(shard["doc_ids"], sizes.tolist(), firsts.tolist(), matches)]

    kinds = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                       ("spans", pa.list_(pa.struct([("item", pa.string()), ("first", pa.int32()), ("last", pa.int32())])))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_pylist(match(batch.slice(i, 1).to_pylist()[0]), schema=kinds)

    return index.join(found, "shard", "left").drop("shard").mapInArrow(rows, MATCH_SCHEMA)


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10, slop: int = 0, doc_id_col: str = "doc_id", doc_text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Index the documents in the shared folder and look up every window of the items."""
    spark = docs.sparkSession
    path = scratch_path(spark, "postings")
    windows = item_windows(items, size, item_id_col, item_text_col)
    build_index(docs, path, term_buckets(windows), doc_id_col, doc_text_col)
    index = read_index(spark, path)
    return find_matches(index, shard_windows(index, ordered_windows(index, windows)), slop)


def report(matches: DataFrame) -> DataFrame:
    """The digest columns of the matches."""
    return matches.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                          F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
