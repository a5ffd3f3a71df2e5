"""Byte-level BPE encoding and decoding by longest matches and backtracking.

The vocabulary is a file of ranks (base64 of a token's bytes, its rank = id).
Bytes are read as Latin-1 so that an Aho-Corasick automaton over strings finds
every token in a piece; the longest token at each position is tried first.  A
token may follow another only if merging would leave exactly that pair standing
(``Vocabulary.stands``, which undoes merges from the border outwards), and that
is remembered for each pair.  A position from which no token fits is never tried
again, so the work is linear in the piece; the result equals merging by rank.

Defined cases: a null or empty text has no ids and decodes to no bytes; equal
rows give equal results, one row each; a null doc_id stays null; an empty table
gives an empty result; other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Memo, byte_chunks, collector_off, id_text

#: Bytes for remembered pairs of tokens, which cost more to find than chunks do.
PAIR_BYTES = 112 << 20

_SPACE_RUN = re.compile(r"\s\s")
MARKS = ",.!?;:"


class Vocabulary:
    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.above = max(self.tokens) + 1
        self.pattern = regex.compile(pattern)
        self.lengths = [0] * self.above
        for rank, token in self.tokens.items():
            self.lengths[rank] = len(token)
        self.pairs, self.chunks = Memo(self._follows, PAIR_BYTES), Memo(self._packed)
        self.halves: dict[int, tuple[int, int]] = {}
        self.shorter: dict[int, int | None] = {}
        self.automaton = ahocorasick.Automaton()
        for rank in sorted(self.tokens):
            if self._split(rank):
                self.automaton.add_word(self.tokens[rank].decode("latin-1"), rank)
        for rank in self.halves:
            token = self.tokens[rank]
            self.shorter[rank] = next((r for n in range(len(token) - 1, 0, -1) if (r := self.ranks.get(token[:n])) in self.halves), None)
        self.automaton.make_automaton()

    def _split(self, rank: int) -> bool:
        """Find the two tokens whose merge makes this one; False if merging never makes it."""
        token = self.tokens[rank]
        if len(token) == 1:
            self.halves[rank] = rank, rank
            return True
        for n in range(len(token) - 1, 0, -1):
            left, right = self.ranks.get(token[:n]), self.ranks.get(token[n:])
            if left in self.halves and right in self.halves and left < rank and right < rank and self.stands(left, right, rank):
                self.halves[rank] = left, right
                return True
        return False

    def stands(self, left: int, right: int, below: int) -> bool:
        """Whether merges of a rank under ``below`` leave a border between these two tokens.

        Seen backwards: while the token made last on either side is undone, no
        merge across the border may have come earlier than that one.
        """
        while True:
            joined = self.ranks.get(self.tokens[left] + self.tokens[right])
            if joined is not None and joined < below:
                return False
            undo_left = left > right
            for _ in range(2):
                if undo_left and (part := self.halves[left][1]) != left:
                    below, left = left, part
                    break
                if not undo_left and (part := self.halves[right][0]) != right:
                    below, right = right + 1, part
                    break
                undo_left = not undo_left
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, lengths, pairs, shorter, above = len(piece), self.lengths, self.pairs, self.shorter, self.above
        longest: list[int | None] = [None] * (size + 1)
        for end, rank in self.automaton.iter(piece.decode("latin-1")):  # later matches from one start are longer
            longest[end + 1 - lengths[rank]] = rank
        dead = bytearray(size + 1)
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < size:
            while token is not None:
                if not dead[at + lengths[token]] and (last < 0 or pairs[last * above + token]):
                    break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at += lengths[token]
                last, token = token, longest[at]
            elif not out:
                raise ValueError("the vocabulary lacks a byte of the text")
            else:
                dead[at] = 1
                token = out.pop()
                last = out[-1] if out else -1
                at -= lengths[token]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text, each match of the pattern by itself.

        The pattern never joins what a single space separates, so texts are cut
        there and each distinct chunk is split by the pattern once; texts with
        runs of white space are split whole.
        """
        if _SPACE_RUN.search(text):
            return self.split(text)
        head, *rest = text.split(" ")
        packed = b"".join(map(self.chunks.__getitem__, rest))
        return self.split(head) + memoryview(packed).cast("I").tolist()

    def _follows(self, pair: int) -> bool:
        """Whether a token may follow another."""
        return self.stands(*divmod(pair, self.above), self.above)

    def _packed(self, chunk: str) -> bytes:
        """Packed ids of a space and the chunk that follows it."""
        head = chunk.rstrip(MARKS)
        if not head.isalpha():
            return array("I", self.split(" " + chunk)).tobytes()
        if len(head) == len(chunk):  # one piece of letters
            return array("I", self.encode_piece(b" " + chunk.encode())).tobytes()
        return self.chunks[head] + array("I", self.encode_piece(chunk[len(head) :].encode())).tobytes()  # and one of marks

    def trim(self) -> None:
        self.chunks.trim(keep=0.25)
        self.pairs.trim(keep=0.25)

    def forget(self) -> None:
        self.chunks.clear()
        self.pairs.clear()

    def split(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary_of(ranks_path: str, pattern: str) -> Vocabulary:
    """One vocabulary for all tasks of a Python worker; each task starts and leaves with empty memos."""
    return Vocabulary(ranks_path, pattern)


def ids_row(doc_id: int | None, ids: list[int], decoded: bytes) -> dict:
    return {"doc_id": doc_id, "ids": ids, "decoded": decoded}


IDS_SCHEMA = "doc_id long, ids array<int>, decoded binary"


def digest_row(doc_id: int | None, ids: list[int], decoded: bytes) -> dict:
    decimal = ",".join(map(_DECIMAL.__getitem__, ids)).encode()
    return {"doc_id": doc_id, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(decimal).hexdigest(), "decoded_sha256": hashlib.sha256(decoded).hexdigest()}


class _Decimal(dict):
    def __missing__(self, number: int) -> str:
        found = self[number] = str(number)
        return found


_DECIMAL = _Decimal()
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, row=ids_row, schema: str = IDS_SCHEMA,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode its ids again; a row for each
    document, made by ``row(doc_id, ids, decoded bytes)``.  No
    shuffle: each task encodes the documents it reads."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, kinds = vocabulary_of(ranks_path, pattern), _schema(schema)
        try:
            for ids, texts in byte_chunks(batches):
                vocabulary.trim()
                out = []
                with collector_off():
                    for doc_id, text in zip(ids, texts):
                        encoded = vocabulary.encode(text.decode())
                        out.append(row(doc_id, encoded, vocabulary.decode(encoded)))
                yield pa.RecordBatch.from_pylist(out, schema=kinds)
        finally:
            vocabulary.forget()

    return id_text(docs, id_col, text_col).mapInArrow(rows, schema)
