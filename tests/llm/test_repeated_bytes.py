import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from marketlake.llm import repeated_bytes
from marketlake.llm.queries import op11_repeated_bytes

from .conftest import ODD


def brute(pairs, size):
    data = [(t or "").encode() for _, t in pairs]
    seen = Counter(b[p : p + size] for b in data for p in range(len(b) - size + 1))
    out = []
    for (d, _), b in zip(pairs, data):
        gone = np.zeros(len(b) + 2, np.int64)
        for p in range(len(b) - size + 1):
            if seen[b[p : p + size]] > 1:
                gone[p + 1] += 1
                gone[p + size + 1] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(docs, size, gram, **more):
    return sorted(map(tuple, repeated_bytes.remove_repeats(docs, repeated_bytes.digest_columns, repeated_bytes.DIGEST_SCHEMA, size, gram, **more).collect()), key=str)


def test_op11_against_brute_force(spark, sf_small):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = sorted(map(tuple, op11_repeated_bytes(spark, sf_small).collect()), key=str)
    assert got == brute(pairs, 200) and any(0 < r[2] < r[1] for r in got)


@pytest.mark.parametrize("seed,size,gram,crowd", [(1, 6, 2, 10_000), (2, 8, 4, 10_000), (3, 9, 3, 2), (4, 7, 4, 0)])
def test_small_alphabets(spark, make_docs, seed, size, gram, crowd):
    """Few distinct bytes: strings overlap, repeat inside a text, tie and chain; with a low crowd, strings are grouped one by one."""
    rng = random.Random(seed)
    pairs = [(rng.randrange(40), "".join(rng.choice("aaabé\n") for _ in range(rng.randrange(60)))) for _ in range(50)]
    pairs += [(60, "a" * 300), (61, "ab" * 90), (62, None), (63, ""), (None, pairs[0][1]), (64, pairs[1][1] + "x"), (65, "qwertyuiop" * 2)]
    assert removed(make_docs(pairs).repartition(5), size, gram, crowd=crowd) == brute(pairs, size)


def test_odd_rows(spark, make_docs):
    assert removed(make_docs(ODD), 12, 4) == brute(ODD, 12)
    assert removed(make_docs([]), 200, 64) == []


def test_a_passage_in_many_texts(spark, make_docs):
    """Near copies: a shared passage between words of their own, some with one letter changed."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9)))
    passage = " ".join(word() for _ in range(90))
    pairs = []
    for k in range(40):
        p = passage if k % 3 else passage[: 9 * k] + "#" + passage[9 * k + 1 :]
        pairs.append((k, " ".join(word() for _ in range(rng.randrange(40))) + " " + p[rng.randrange(30) :] + " ".join(word() for _ in range(30))))
    for crowd in (10_000, 8):
        assert removed(make_docs(pairs), 200, 64, crowd=crowd) == brute(pairs, 200)


def test_runs_and_bytes_that_stay(spark, make_docs):
    got = repeated_bytes.remove_repeats(make_docs([(1, "xxHELLOyy"), (2, "HELLO"), (3, "é")]), size=5, gram=2).collect()
    assert {r.doc_id: (r.runs, bytes(r.kept)) for r in got} == {1: ([2, 7], b"xxyy"), 2: ([0, 5], b""), 3: ([], "é".encode())}


def test_gram_hashes_of_equal_grams_are_equal():
    data = np.frombuffer(b"abcabcabcabd", np.uint8)
    for gram in (1, 2, 3, 5, 6):
        h = repeated_bytes.gram_hashes(data, gram)
        assert len(h) == len(data) - gram + 1
        for i in range(len(h)):
            for j in range(len(h)):
                assert (h[i] == h[j]) == (data[i : i + gram].tobytes() == data[j : j + gram].tobytes())
