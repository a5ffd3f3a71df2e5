"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces.

A text is cut without losing a byte: lines are paragraphs, a blank line ends a
section, and a paragraph is cut into pieces where a rolling hash of the last
GRAM bytes says so, once in some CUT bytes, and after LONGEST at the latest.
Cuts depend on the bytes just before them only, in any script and without white
space, so an edit moves none but those beside it.  A piece's hash is that of its
bytes, any other node's that of its children's full hashes; the root's also
covers the text's length.  Equal roots mean equal texts (128-bit hashes).

The fingerprint is the tree written out, hashes cut to a few digits below the
root: ``root:section/section``, a section being ``hash=paragraph,paragraph`` and a
paragraph ``hash-pieces`` with PIECE_HEX digits for each piece.  ``differing``
walks two trees from the root into differing branches only and names the
paragraphs that differ.

Likeness is the share of characters in pieces that two trees have in common,
twice the common ones over all of them (1.0 for two empty texts).

``edited_pairs`` sets each document beside the next one in descending order of
doc_id without a join: documents are dealt out by ranges of (doc_id, hash of the
text), so an id that a third of all rows share is spread over several ranges; the
first document of each range is sent to the range above it as well, and a task
reads its range in order with one document held back.

Defined cases: a null text is empty; equal rows have equal fingerprints, one row
each; rows that share a doc_id follow each other by descending md5 of their
texts; a null doc_id stands below every other id; a single document is its own
next; an empty table gives an empty result; texts are handled in chunks of 4 MB,
a longer one in a chunk of its own; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, sub_batches
from .repeated_bytes import gram_hashes

PIECE_HEX = 6
NODE_HEX = 12
#: Bytes that decide a cut, mean distance of cuts, longest piece.
GRAM, CUT, LONGEST = 8, 16, 32
NO_ID = -(1 << 63)


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _cuts(data: np.ndarray, line_ends: np.ndarray) -> np.ndarray:
    """Ends of the pieces: ends of lines, places that the rolling hash names, and every LONGEST bytes of what is left."""
    n = len(data)
    ends = line_ends
    if n >= GRAM:
        at = np.flatnonzero(gram_hashes(data, GRAM) % np.uint64(CUT) == 0) + GRAM
        begins = np.concatenate([[0], line_ends[:-1]])
        line = np.searchsorted(line_ends, at - 1, side="right")
        at = at[at - begins[line] >= GRAM]  # the bytes that decide are of one line
        ends = np.union1d(line_ends, at)
    sizes = np.diff(ends, prepend=0)
    extra = (sizes - 1) // LONGEST
    if not extra.any():
        return ends
    long = np.flatnonzero(extra)
    steps = np.arange(extra[long].sum()) - np.repeat(np.cumsum(extra[long]) - extra[long], extra[long]) + 1
    return np.union1d(ends, np.repeat(ends[long] - sizes[long], extra[long]) + steps * LONGEST)


def tree(text: str) -> tuple[str, Counter]:
    """The fingerprint of a text, and the characters in its pieces by their hashes."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    pieces: Counter = Counter()
    sections: list[tuple[bytes, str]] = []
    paragraphs: list[tuple[bytes, str]] = []

    def close() -> None:
        if paragraphs:
            sections.append((head := _hash(b"".join(h for h, _ in paragraphs)), f"{head.hex()[:NODE_HEX]}={','.join(p for _, p in paragraphs)}"))
            paragraphs.clear()

    if raw:
        line_ends = np.union1d(np.flatnonzero(data == 10) + 1, [len(raw)])
        ends = _cuts(data, line_ends)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        weights = np.diff(chars[ends], prepend=0).tolist()
        stops = ends.tolist()
        hashes = [_hash(raw[a:b]) for a, b in zip([0, *stops], stops)]
        for h, w in zip(hashes, weights):
            pieces[h] += w
        at = 0
        for begin, end, stop in zip([0, *line_ends.tolist()], line_ends.tolist(), (np.searchsorted(ends, line_ends) + 1).tolist()):
            own = hashes[at:stop]
            name = _hash(b"".join(own))
            paragraphs.append((name, f"{name.hex()[:NODE_HEX]}-{''.join(h.hex()[:PIECE_HEX] for h in own)}"))
            at = stop
            if raw[begin:end].isspace():
                close()
        close()
    root = _hash(f"{len(text)}:".encode() + b"".join(h for h, _ in sections))
    return f"{root.hex()}:{'/'.join(s for _, s in sections)}", pieces


def fingerprint(text: str) -> str:
    return tree(text)[0]


def likeness(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    if len(a) > len(b):
        a, b = b, a
    return 2 * sum(min(n, b[p]) for p, n in a.items() if p in b) / total if total else 1.0


def _sections(fingerprint: str) -> list[tuple[str, list[str]]]:
    return [(head, body.split(",")) for head, _, body in (s.partition("=") for s in fingerprint.partition(":")[2].split("/") if s)]


def differing(a: str, b: str) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs of each text that the other lacks; equal roots and branches are not entered."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return [], []

    def lacking(own: str, other: str) -> list[int]:
        same = Counter(head for head, _ in _sections(other))
        theirs = Counter(p.partition("-")[0] for _, ps in _sections(other) for p in ps)
        out, at = [], 0
        for head, paragraphs in _sections(own):
            entered = not same[head]
            same[head] -= not entered
            for k, p in enumerate(paragraphs):
                name = p.partition("-")[0]
                if entered and not theirs[name]:
                    out.append(at + k)
                theirs[name] -= theirs[name] > 0
            at += len(paragraphs)
        return out

    return lacking(a, b), lacking(b, a)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every document; no shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            made = [fingerprint(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    return id_text(docs, id_col, text_col).mapInArrow(rows, "doc_id long, fingerprint string")


def _dealt(docs: DataFrame) -> DataFrame:
    """(place, turn, key, mark, doc_id, text): each document in its range of (id, mark), place, and
    the first of a range also in the range above it (or the first of all in the last), at turn 1; a
    partition for each range.  A mark is the leading 60 bits of the text's md5; an id that fills
    several ranges by itself is cut into as many by its marks."""
    spark = docs.sparkSession
    mark = F.conv(F.substring(F.md5(F.coalesce("text", F.lit(""))), 1, 15), 16, 10).cast("long")
    keyed = docs.withColumns({"key": F.coalesce("doc_id", F.lit(NO_ID)), "mark": mark})
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = keyed.agg(F.percentile_approx("key", [k / count for k in range(1, count)], 10 * count).alias("cuts")).first().cuts
    bounds, times = np.unique(np.array(cuts or [], np.int64), return_counts=True)
    # Places ascend with (key, mark).  Below bound k are the places of the bounds before it and their gaps;
    # a bound that was cut several times has that many places, one cut once shares the place above it.
    wide = np.where(times > 1, times, 0)
    first = np.concatenate([[0], np.cumsum(wide + 1)])

    def placed(key: np.ndarray, mark: np.ndarray) -> np.ndarray:
        at = np.searchsorted(bounds, key, side="right")
        place = first[at]
        if len(bounds):
            hot = (bounds[np.maximum(at - 1, 0)] == key) & (at > 0) & (wide[np.maximum(at - 1, 0)] > 0)
            of = np.maximum(at - 1, 0)
            inside = (mark.astype(np.float64) / 2.0**60 * wide[of]).astype(np.int64)
            place = np.where(hot, first[of] + 1 + np.minimum(inside, wide[of] - 1), np.where(at > 0, first[of] + 1 + wide[of], 0))
        return place

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[int, int]] = {}
        for batch in batches:
            key, mark = (batch.column(k).to_numpy() for k in (0, 1))
            place = placed(key, mark)
            order = np.lexsort([mark, key, place])
            last = order[np.append(np.diff(place[order]) != 0, True)] if len(order) else order
            for p, k, m in zip(place[last].tolist(), key[last].tolist(), mark[last].tolist()):
                best[p] = max((k, m), best.get(p, (k, m)))
        yield pa.RecordBatch.from_arrays([pa.array(best.keys(), pa.int32()), *[pa.array([v[c] for v in best.values()], pa.int64()) for c in (0, 1)]], ["place", "key", "mark"])

    found = keyed.select("key", "mark").mapInArrow(tops, "place int, key long, mark long").groupBy("place").agg(F.max(F.struct("key", "mark")).alias("top"))
    top = {r.place: tuple(r.top) for r in found.collect()}  # a row for each range
    number = {p: k for k, p in enumerate(sorted(top))}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 3):
            key, mark = (batch.column(k).to_numpy() for k in (0, 1))
            place = placed(key, mark)
            firsts, seen = [], set()
            for row, at in enumerate(zip(place.tolist(), key.tolist(), mark.tolist())):
                if top[at[0]] == at[1:] and at not in seen:
                    seen.add(at)
                    firsts.append(row)
            own = [number[p] for p in place.tolist()]
            above = [(own[r] + 1) % len(number) for r in firsts]  # the last range's first document comes after the lowest range
            taken = batch.take(pa.array([*range(batch.num_rows), *firsts], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(own + above, pa.int32()), pa.array([0] * len(own) + [1] * len(above), pa.int32()), *taken.columns],
                                             ["place", "turn", *batch.schema.names])

    dealt = keyed.select("key", "mark", "doc_id", "text").mapInArrow(rows, "place int, turn int, key long, mark long, doc_id long, text string")
    return dealt.repartitionById(max(1, len(number)), F.col("place"))


PAIR_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its edited text, its second
    half replaced by as much of the next document, and the next document's."""
    names = [f.split()[0] for f in PAIR_SCHEMA.split(", ")]

    def compared(held: tuple, following: str, next_pieces: Counter) -> tuple:
        doc_id, text, mark, pieces = held
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        edited_mark, edited_pieces = (mark, pieces) if edited == text else tree(edited)
        return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mark, edited_mark,
                likeness(pieces, edited_pieces), likeness(pieces, next_pieces))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = at = None
        for batch in sub_batches(batches, 3):
            out = []
            for place, turn, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if place == at and held is None:
                    continue  # further rows of the range below
                text = text or ""
                mark, pieces = tree(text)
                if held is not None:
                    out.append(compared(held, text, pieces))
                held, at = None if turn else (doc_id, text, mark, pieces), place
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], names)

    ordered = (_dealt(id_text(docs, id_col, text_col))
               .sortWithinPartitions("place", "turn", F.desc("key"), F.desc("mark")).select("place", "turn", "doc_id", "text"))
    return ordered.mapInArrow(rows, PAIR_SCHEMA)
