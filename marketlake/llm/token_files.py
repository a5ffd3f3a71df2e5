"""Token-id files with fixed-width bit packing.

``write_token_files`` encodes documents with a vocabulary file of the
tokenizers library and writes their ids as a folder of Parquet files whose rows
are blocks.  A block holds whole documents in ascending id order:

    part, block      position of the block: blocks sort by (part, block)
    doc_ids, sizes   the documents of the block and their numbers of ids
    offset, n_ids    ids of the part before the block, ids in it
    bits             bits of one id: the fewest that hold the vocabulary
    payload          the ids, ``bits`` each, least significant bit first

The offset of document k in its block is the sum of the sizes before it, so one
document's bits start at ``offset * bits`` and are unpacked alone
(``read_token_files(doc_ids=...)``), or a whole block is unpacked at once.

Parquet carries the blocks because Spark's commit protocol makes the folder
whole under task retries and lost executors, on any file system.

Defined cases: a null text is empty; an empty document holds only the end id; a
null doc_id sorts first; rows that share a doc_id stay separate, ordered by
text; an empty table writes an empty folder with the schema; other columns of
the input are not looked at.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Memo, byte_chunks, collector_off, id_text

BLOCK_SCHEMA = "part int, block int, first_doc long, last_doc long, doc_ids array<bigint>, sizes array<int>, offset long, n_ids long, bits int, payload binary"
BLOCK_IDS = 1 << 15
#: Words sent to the tokenizers library in one text.
AT_ONCE = 1000

_MARKS, _LETTERS = b",.!?;:", b"abcdefghijklmnopqrstuvwxyz"
_WORD = _LETTERS + bytes(range(0x80, 0x100))


def id_bits(vocabulary: int) -> int:
    """Bits that hold every id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    cells = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(cells.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from id ``start`` on."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, start * bits // 8).astype(np.uint32)
    first, last = start * bits // 8, -(-(start + count) * bits // 8)
    flat = np.unpackbits(np.frombuffer(payload, np.uint8)[first:last], bitorder="little")
    skip = start * bits - first * 8
    cells = flat[skip : skip + count * bits].reshape(count, bits).astype(np.uint32)
    return (cells << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class WordEncoder:
    """Ids of whole texts, equal to ``encode(text, add_special_tokens=False)``.

    The tokenizer drops white space and never merges across it, so a text's
    ids are its words' ids in order.  Words recur, so each distinct word goes
    through the library once.  Texts for which that does not hold (a string of
    an added token, combining marks that could compose with a lower-cased
    letter) go through the library whole.
    """

    def __init__(self, path: str, memo_bytes: int = 128 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # Words of a-z need no normalizing, and are what the pattern finds between spaces.
        self.plain.normalizer, self.plain.pre_tokenizer = None, WhitespaceSplit()
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(self.vocabulary, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.memo = Memo(limit=memo_bytes)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        self.memo.trim(keep=0.25)
        with collector_off():
            words = [t.lower().split() if self.by_words(t) else [] for t in texts]
            found = [list(map(self.memo.get, w)) for w in words]
            missing = [[x for x, known in zip(w, f) if known is None] for w, f in zip(words, found)]
            self._learn({x for m in missing for x in m})
            out = []
            for text, f, m in zip(texts, found, missing):
                ids = map(self.memo.__getitem__, m)
                out.append(b"".join([next(ids) if known is None else known for known in f] if m else f) if self.by_words(text) else self._whole(text))
            return out

    @staticmethod
    def by_words(text: bytes) -> bool:
        return b"<|" not in text and b"\xcc" not in text and b"\xcd" not in text

    def _whole(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        whole, heads, tails = [], [], []  # letters followed by marks: two words to the tokenizer
        for w in words:
            if w[-1] in _MARKS and (head := w.rstrip(_MARKS)) and head[-1] in _LETTERS and not head.translate(None, _WORD):
                whole.append(w)
                heads.append(head)
                tails.append(w[len(head) :])
        self._encode_words(list(words.difference(whole).union(heads, tails) - self.memo.keys()))
        ids = self.memo.__getitem__
        self.memo.update(zip(whole, map(add, map(ids, heads), map(ids, tails))))

    def _encode_words(self, words: list[bytes]) -> None:
        strings = b" ".join(words).decode().split(" ") if words else []
        kinds: dict[bool | None, list[tuple[bytes, str]]] = {True: [], False: [], None: []}
        for pair in zip(words, strings):
            kinds[pair[1].isascii() if pair[1].isalpha() else None].append(pair)
        alone = kinds[None] + self._encode_joined(self.plain, kinds[True]) + self._encode_joined(self.tokenizer, kinds[False])
        for i in range(0, len(alone), AT_ONCE):
            group = alone[i : i + AT_ONCE]
            for (word, _), e in zip(group, self.tokenizer.encode_batch_fast([s for _, s in group], add_special_tokens=False)):
                self.memo[word] = np.array(e.ids, "<u4").tobytes()

    def _encode_joined(self, tokenizer, pairs: list[tuple[bytes, str]]) -> list[tuple[bytes, str]]:
        """Words of letters, many in one text; returns those whose ids could not be told apart."""
        left = []
        for i in range(0, len(pairs), AT_ONCE):
            group = pairs[i : i + AT_ONCE]
            ids = np.array(tokenizer.encode_batch_fast([" ".join([s for _, s in group])], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) == len(group):  # each word has at least one end, so here exactly one
                packed = ids.tobytes()
                self.memo.update(zip([w for w, _ in group], [packed[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                left += group
        return left


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """One encoder, with a memo of bounded size, for all tasks of a Python worker."""
    return WordEncoder(path)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = 1, id_col: str = "doc_id",
                      text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every document, append ``end_id`` and write the blocks to ``path``.

    Documents are dealt out by ranges of ids, so files are in order overall;
    each task holds one block and one chunk of text at a time.
    """
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(tokenizer_path), TaskContext.get().partitionId()
        bits = id_bits(max(encoder.vocabulary, (end_id or 0) + 1))
        number, offset, size, held, doc_ids, sizes = 0, 0, 0, [], [], []

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            named = [i for i in doc_ids if i is not None]
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([number], pa.int32()),
                "first_doc": pa.array([min(named, default=None)], pa.int64()), "last_doc": pa.array([max(named, default=None)], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "sizes": pa.array([sizes], pa.list_(pa.int32())),
                "offset": pa.array([offset], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()), "bits": pa.array([bits], pa.int32()), "payload": pa.array([pack(ids, bits)], pa.binary()),
            })

        for ids, texts in byte_chunks(batches):
            for doc_id, encoded in zip(ids, encoder.encode(texts)):
                held.append(encoded + tail)
                doc_ids.append(doc_id)
                sizes.append(len(held[-1]) // 4)
                size += sizes[-1]
                if size >= block_ids:
                    yield block()
                    number, offset, size, held, doc_ids, sizes = number + 1, offset + size, 0, [], [], []
        if doc_ids:
            yield block()

    ordered = id_text(docs, id_col, text_col).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``: the number of ids before the block.

    Blocks know their offset in their part; the parts' totals, one row for each
    written part, are summed up and broadcast, so no payload is shuffled.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")))
    return blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("part_start") + F.col("offset"))


def ids_row(doc_id: int | None, start: int, ids: np.ndarray) -> dict:
    return {"doc_id": doc_id, "start": start, "ids": ids.tolist()}


IDS_SCHEMA = "doc_id long, start long, ids array<bigint>"


def crc_row(doc_id: int | None, start: int, ids: np.ndarray) -> dict:
    return {"doc_id": doc_id, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


CRC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_files(spark: SparkSession, path: str, row=ids_row, schema: str = IDS_SCHEMA, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """One row for each document, made by ``row(doc_id, start, ids)``.

    With ``doc_ids`` only blocks whose id range holds one of them are read (the
    range columns prune row groups) and only those documents are unpacked.
    """
    blocks = read_blocks(spark, path)
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        blocks = blocks.where(F.lit(False) if not wanted else
                              (F.col("last_doc") >= min(wanted)) & (F.col("first_doc") <= max(wanted))
                              & F.arrays_overlap("doc_ids", F.array(*map(F.lit, wanted))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                out, at = [], 0
                for doc_id, size in zip(b["doc_ids"], b["sizes"]):
                    if wanted is None or doc_id in wanted:
                        out.append(row(doc_id, b["start"] + at, unpack(b["payload"], b["bits"], at, size)))
                    at += size
                if out:
                    yield pa.RecordBatch.from_pylist(out)

    slim = blocks.select("start", "doc_ids", "sizes", "bits", "payload")
    return slim.mapInArrow(rows, schema)
