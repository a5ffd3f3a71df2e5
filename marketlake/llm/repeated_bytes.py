"""Repeated byte strings by prefix-free parsing.

A byte goes if a string of SIZE bytes over it also starts anywhere else, in the
same text or in another.  Strings do not cross texts.

Triggers.  A rolling hash is taken of every GRAM bytes; the place with the
smallest hash in a string of SIZE bytes is its trigger (the first one of equals).
Equal strings have their trigger at the same place, no text of SIZE bytes is
without one, and a trigger cuts the text: the strings that belong to it start at
neighbouring places and lie in one phrase, from the first start to the last end.

Dictionary.  Distinct texts first, then distinct phrases (128-bit hash), each
with its count and occurrences, grouped map-side in Spark.  Phrases whose trigger
string occurs once end there.  A phrase that occurs twice has nothing but
repeated strings.  So only phrases that occur once beside other phrases of the
same trigger string are compared, and the corpus order below is needed for one
copy of each distinct phrase, whatever the repetition.

Order.  A string is a suffix of the phrase's part before the trigger and a prefix
of what follows from the trigger on.  The parts before are sorted backwards (the
suffix order of the dictionary), the parts from the trigger on forwards (the order
of the parse, cut off where no string reaches), each with the common length of
neighbours.  Together they give the place of every string in corpus order: two
strings are equal if they share the run of common suffixes of their length in the
first order and the run of common prefixes of theirs in the second.

Hot groups.  Copies of a text are one text with a count.  Joins of occurrences with
triggers and phrases have one row a trigger or phrase on the other side, so the
adaptive planner can split a passage that a third of all texts share.  Phrases of
a trigger string that occurs over CROWD times are not gathered: their strings are
grouped by 128-bit hashes instead, after each task has settled its own.

Defined cases: a null text is empty; a text below SIZE bytes is left alone (its
spans are empty); copies of a text go wholly, all of them; a null or shared id is
carried along and decides nothing; an empty table gives an empty result; texts
are handled in chunks of 4 MB, a longer one in a chunk of its own; other columns
are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, sub_batches, texts_of

SIZE, GRAM = 200, 64
#: Occurrences of a trigger string from which its phrases are not gathered.
CROWD = 10_000

PHRASES_SCHEMA = "trigger long not null, c1 long not null, c2 long not null, n long not null, mark binary not null, body binary not null"
PARTS_SCHEMA = "kind int, k1 long, k2 long, n int, mark binary, start int, place int, body binary"
SPANS_SCHEMA = "mark binary not null, pairs binary not null"
GATHERED, STRING, KNOWN = range(3)

# An odd multiplier of the rolling hash, and the seed of its table of bytes.
_FACTOR, _SEED = 0x9E3779B97F4A7C15, 11


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return a ^ (a >> np.uint64(32))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram`` neighbouring bytes, by doubling."""
    table = np.random.default_rng(_SEED).integers(0, 2**64, 256, np.uint64)
    h, have = table[data], 1
    while have < gram:
        step = min(have, gram - have)
        if step == have:
            h, have = h[:-step] * np.uint64(pow(_FACTOR, step, 1 << 64)) + h[step:], 2 * have
        else:  # the last runs overlap, which is no harm to equal strings
            h, have = h[:-step] * np.uint64(pow(_FACTOR, gram, 1 << 64)) + h[step:], gram
    return _mixed(h)


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the first of the least of every ``width`` neighbours stands."""
    at, have = np.arange(len(values), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        right = values[step:] < values[:-step]
        values, at = np.where(right, values[step:], values[:-step]), np.where(right, at[step:], at[:-step])
        have += step
    return at


def parse(texts: list[bytes], size: int, gram: int) -> tuple[np.ndarray, ...]:
    """(owner, first start, span, trigger, hash of the trigger string): the phrases of the texts, places within all of them joined."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < size:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    starts = np.flatnonzero(owner[: len(data) - size + 1] == owner[size - 1 :])
    hashes = gram_hashes(data, gram)
    triggers = _first_least(hashes, size - gram + 1)[starts]
    new = np.flatnonzero(np.diff(triggers, prepend=-1))
    first = starts[new]
    last = starts[np.append(new[1:], len(starts)) - 1] if len(new) else first
    at = triggers[new].astype(np.int64)
    return owner[first].astype(np.int64), first, last - first, at, hashes[at]


def _phrases(size: int, gram: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every distinct phrase of every text: (mark, text, copies) -> PHRASES_SCHEMA."""
    for batch in sub_batches(batches):
        texts = texts_of(batch.column(1))
        copies = batch.column(2).to_numpy()
        owner, first, span, trigger, name = parse(texts, size, gram)
        if not len(first):
            continue
        whole = memoryview(b"".join(texts))
        digest = xxhash.xxh3_128_digest
        ends = first + span + size
        hashes = np.frombuffer(b"".join([digest(whole[a:b]) for a, b in zip(first.tolist(), ends.tolist())]), "<i8").reshape(-1, 2)
        order = np.lexsort([first, hashes[:, 1], hashes[:, 0], owner])
        c1, c2, of = hashes[order, 0], hashes[order, 1], owner[order]
        new = np.flatnonzero(np.concatenate([[True], (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1]) | (of[1:] != of[:-1])]))
        count = np.diff(np.append(new, len(order)))
        begins = np.cumsum([0, *map(len, texts)])
        places = (first - begins[owner])[order].astype("<i4").tobytes()
        heads = np.stack([trigger - first, span], axis=1)[order[new]].astype("<i4").tobytes()
        cuts = (4 * np.append(new, len(order))).tolist()
        yield pa.RecordBatch.from_arrays([
            pa.array(name[order[new]].view(np.int64)), pa.array(c1[new]), pa.array(c2[new]), pa.array(count * copies[of[new]]), batch.column(0).take(pa.array(of[new])),
            # place of the trigger, span, and every start of the phrase in this text
            pa.array([heads[8 * k : 8 * k + 8] + places[a:b] for k, (a, b) in enumerate(zip(cuts, cuts[1:]))], pa.binary()),
        ], _names(PHRASES_SCHEMA))


def _windows(start: int, span: int) -> bytes:
    return np.array([span, start], "<i4").tobytes()


def _parts(size: int, crowd: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is known of the phrases of every text, and the bytes of those that are to be compared;
    under crowded triggers string by string: (mark, text, copies, asked) -> PARTS_SCHEMA."""
    for batch in sub_batches(batches):
        rows, strings, keys = [], [], []
        for mark, text, asked in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(3).to_pylist()):
            home = int.from_bytes(mark[:8], "little", signed=True)
            for a in asked:
                place, span, start = np.frombuffer(a["body"], "<i4", 3).tolist()
                n = min(a["all"], 2)
                if n > 1:
                    rows.append((KNOWN, home, start, n, mark, start, place, a["body"][4:]))
                if not a["compare"]:
                    continue
                if a["total"] <= crowd:
                    rows.append((GATHERED, a["trigger"], 0, n, mark, start, place, text[start : start + span + size]))
                    continue
                for p in range(start, start + span + 1):
                    strings.append((mark, p, n))
                    keys.append(xxhash.xxh3_128_digest(text[p : p + size]))
        hashes = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
        order = np.lexsort([hashes[:, 1], hashes[:, 0]])
        new = np.flatnonzero(np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]).any(axis=1)])) if len(order) else order
        for a, b in zip(new, np.append(new[1:], len(order))):
            same = [strings[k] for k in order[a:b]]
            n = min(2, sum(x[2] for x in same))
            # Strings that meet here are settled here; one row speaks for them elsewhere.
            if len(same) > 1:
                rows += [(KNOWN, int(hashes[k, 1]) ^ p, p, n, mark, p, 0, _windows(p, 0)) for k, (mark, p, _) in zip(order[a:b], same)]
            rows.append((STRING, *hashes[order[a]].tolist(), n, *same[0][:2], 0, None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PARTS_TYPES)], _names(PARTS_SCHEMA))


PARTS_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]


def _common(parts: list[bytes], groups: np.ndarray) -> np.ndarray:
    """Common length of every part with the one before it (below zero where the group changes); parts are sorted."""
    lengths = np.array([len(p) for p in parts])
    width = int(lengths.max(initial=0)) + 1
    grid = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width)
    differ = grid[1:] != grid[:-1]
    differ[:, -1] = True
    common = np.minimum(np.argmax(differ, axis=1), np.minimum(lengths[1:], lengths[:-1]))
    return np.concatenate([[-1], np.where(groups[1:] == groups[:-1], common, -1)])


def repeated_strings(groups: np.ndarray, befores: list[bytes], afters: list[bytes], spans: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, length before the trigger) of every string of a phrase that another phrase of its group, or a copy of it, has too."""
    m = len(befores)
    lengths = np.array([len(b) for b in befores])
    runs = []
    for parts in ([b[::-1] for b in befores], afters):
        order = np.array(sorted(range(m), key=lambda k: (groups[k], parts[k])))
        rank = np.empty(m, np.int64)
        rank[order] = np.arange(m)
        runs.append((rank, _common([parts[k] for k in order], groups[order])))
    (suffix, suffixes), (prefix, prefixes) = runs
    found = []
    for j in range(int(lengths.max(initial=-1)) + 1):
        rows = np.flatnonzero((lengths - spans <= j) & (j <= lengths))
        if not len(rows):
            continue
        code = np.cumsum(suffixes < j)[suffix[rows]] * (m + 1) + np.cumsum(prefixes < size - j)[prefix[rows]]
        _, which = np.unique(code, return_inverse=True)
        again = rows[np.bincount(which, counts[rows])[which] > 1]
        found.append((again, np.full(len(again), j)))
    return tuple(np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found) if found else ((), ())))


def _gathered(rows: list[tuple], size: int) -> Iterator[tuple[bytes, bytes]]:
    """(mark, windows) of the phrases that occur once."""
    _, groups = np.unique(np.array([r[1] for r in rows], np.int64), return_inverse=True)
    places = np.array([r[6] for r in rows])
    spans = np.array([len(r[7]) for r in rows]) - size
    row, before = repeated_strings(groups, [r[7][: r[6]] for r in rows], [r[7][r[6] :] for r in rows], spans, np.array([r[3] for r in rows]), size)
    own = np.array([r[3] for r in rows])[row] == 1
    row, start = row[own], (places[row] - before)[own]
    order = np.lexsort([start, row])
    row, start = row[order], start[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)])) if len(row) else row
    for a, b in zip(new, np.append(new[1:], len(row)) - 1):
        r = rows[row[a]]
        yield r[4], _windows(r[5] + int(start[a]), int(start[b] - start[a]))


def _compared(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts to windows: PARTS_SCHEMA -> SPANS_SCHEMA.  Groups of a key are whole; many small ones are compared at once."""
    held, held_bytes, found, last = [], 0, [], None
    waiting = None  # the first string of a key, until a second one comes

    def made():
        return pa.RecordBatch.from_arrays([pa.array([m for m, _ in found], pa.binary()), pa.array([w for _, w in found], pa.binary())], _names(SPANS_SCHEMA))

    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            key = r[:3]
            if r[0] == GATHERED:
                if held_bytes > CHUNK_BYTES and key != last:
                    found += _gathered(held, size)
                    held, held_bytes = [], 0
                held.append(r)
                held_bytes += len(r[7])
            elif r[0] == KNOWN:
                found.append((r[4], r[7]))
            else:
                again = key == last
                if again and waiting is not None:
                    found.append((waiting[4], _windows(waiting[5], 0)))
                waiting = None
                if again or r[3] > 1:
                    found.append((r[4], _windows(r[5], 0)))
                else:
                    waiting = r
            last = key
        if len(found) > 10_000:
            yield made()
            found = []
    if held:
        found += _gathered(held, size)
    if found:
        yield made()


def repeated_spans(texts: DataFrame, size: int = SIZE, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(mark, pairs): for texts (mark, text, copies) with repeated strings, where
    those start, as binaries of a span and starts: each stands for the strings from
    a start to the start plus the span."""
    phrases = texts.mapInArrow(partial(_phrases, size, gram), PHRASES_SCHEMA)
    # Counts lose their partitioning by their key (complemented twice), so a join gives them an exchange of their own, of the
    # repeated keys only, and the planner can split a hot key of the other side; it does not where a join reads an aggregate.
    again = phrases.groupBy("trigger").agg(F.sum("n").alias("total")).where("total > 1").select(F.bitwise_not("trigger").alias("t"), "total")
    candidates = phrases.join(again, F.col("trigger") == F.bitwise_not("t")).drop("t")
    # Both uses of the candidates take all columns of the phrases, so that one exchange serves both.
    own = F.xxhash64("mark", "body")
    counted = candidates.groupBy("c1", "c2").agg(F.sum("n").alias("all"), F.min(own).alias("speaker"))
    named = counted.select(F.bitwise_not("c1").alias("d1"), F.bitwise_not("c2").alias("d2"), "all", "speaker")
    known = candidates.join(named, (F.col("c1") == F.bitwise_not("d1")) & (F.col("c2") == F.bitwise_not("d2")))
    # One copy of every distinct phrase speaks for it, if its trigger string has others; a text is asked for its own phrases at most.
    compare = (F.col("all") < F.col("total")) & (own == F.col("speaker"))
    asked = known.where((F.col("all") > 1) | compare).groupBy("mark").agg(F.collect_list(F.struct(
        "trigger", "n", "all", "total", compare.alias("compare"), "body")).alias("asked"))
    parts = texts.join(asked, "mark").select("mark", "text", "copies", "asked").mapInArrow(partial(_parts, size, crowd), PARTS_SCHEMA)
    dealt = parts.repartition("k1", "k2").sortWithinPartitions("kind", "k1", "k2")
    return dealt.mapInArrow(partial(_compared, size), SPANS_SCHEMA)


def removed_runs(length: int, pairs: list[bytes], size: int) -> np.ndarray:
    """Maximal removed runs of a text as rows of begin and end."""
    change = np.zeros(length + 1, np.int64)
    for pair in pairs:
        span, *starts = np.frombuffer(pair, "<i4").tolist()
        np.add.at(change, starts, 1)
        np.add.at(change, np.array(starts) + span + size, -1)
    gone = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2)


def kept_columns(texts: list[bytes], runs: list[np.ndarray], kept: list[bytes]) -> dict[str, pa.Array]:
    """The removed runs as flat pairs of begin and end, and the bytes that stay."""
    return {"runs": pa.array([r.ravel().tolist() for r in runs], pa.list_(pa.int64())), "kept": pa.array(kept, pa.binary())}


KEPT_SCHEMA = "runs array<long>, kept binary"


def digest_columns(texts: list[bytes], runs: list[np.ndarray], kept: list[bytes]) -> dict[str, pa.Array]:
    return {"n_bytes": pa.array(list(map(len, texts)), pa.int64()), "n_removed": pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64()),
            "n_spans": pa.array(list(map(len, runs)), pa.int64()), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept])}


DIGEST_SCHEMA = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, columns=kept_columns, schema: str = KEPT_SCHEMA, size: int = SIZE, gram: int = GRAM, crowd: int = CROWD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id and what ``columns(texts, removed runs, kept bytes)`` makes of it."""
    plain = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    # Columns that are never null, so that no null check is pushed into one use of an exchange and not into the others.
    marked = plain.withColumn("mark", F.coalesce(F.unhex(F.md5("text")), F.lit(b"")))
    texts = marked.groupBy("mark").agg(F.first("text").alias("text"), F.count("*").alias("copies")).select("mark", "text", "copies")
    spans = repeated_spans(texts, size, gram, crowd).groupBy("mark").agg(F.collect_list("pairs").alias("pairs"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            held, runs, kept = texts_of(batch.column(1)), [], []
            for text, copies, pairs in zip(held, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if copies > 1 and len(text) >= size:
                    runs.append(np.array([[0, len(text)]]))
                else:
                    runs.append(removed_runs(len(text), pairs, size) if pairs else np.zeros((0, 2), np.int64))
                ends = [0, *runs[-1].ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2])))
            made = columns(held, runs, kept)
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.values()], ["mark", *made])

    found = texts.join(spans, "mark", "left").select("mark", "text", "copies", "pairs").mapInArrow(rows, f"mark binary not null, {schema}")
    return marked.select("doc_id", "mark").join(found, "mark").drop("mark")
