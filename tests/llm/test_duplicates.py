import hashlib
import random

import numpy as np
import pytest
import xxhash

from marketlake.llm import components, decontaminate, simhash, substrings
from marketlake.llm.queries import ORACLE, op2_simhash, op3_decontaminate, op5_substrings

from .conftest import ODD


def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    found = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    marks = [brute_fingerprint(t) for _, t in pairs]
    label = list(range(len(pairs)))
    for a in range(len(pairs)):
        for b in range(a):
            if (marks[a] ^ marks[b]).bit_count() <= 2 and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    least = {}
    for x, (d, _) in zip(label, pairs):
        if d is not None:
            least[x] = min(d, least.get(x, d))
    return [(d, f"{m:016x}", least.get(x)) for x, m, (d, _) in zip(label, marks, pairs)]


def test_op2_against_brute_force(spark, sf_small):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert sorted(map(tuple, op2_simhash(spark, sf_small).collect())) == sorted(brute_components(pairs))


def test_near_duplicates_of_odd_rows(spark, make_docs):
    got = simhash.near_duplicates(make_docs(ODD)).collect()
    assert sorted(((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in got), key=str) == sorted(brute_components(ODD), key=str)
    assert simhash.near_duplicates(make_docs([])).count() == 0
    only_null = simhash.near_duplicates(make_docs([(None, "a b c d")])).collect()
    assert [(r.doc_id, r.component_id) for r in only_null] == [(None, None)]


def test_links_are_complete(spark):
    """Random fingerprints and their neighbours at 0 to 3 bits: exactly the pairs within 2 bits."""
    rng = random.Random(5)
    marks = set()
    for _ in range(60):
        mark = rng.getrandbits(64)
        marks.add(mark)
        for n in (1, 1, 2, 2, 2, 3):
            marks.add(mark ^ sum(1 << b for b in rng.sample(range(64), n)))
    marks = sorted(marks)
    want = {(a, b) for i, a in enumerate(marks) for b in marks[i + 1 :] if (a ^ b).bit_count() <= 2}
    signed = [m - 2**64 if m >= 2**63 else m for m in marks]
    got = simhash.links(spark.createDataFrame([(m,) for m in signed], "fp long")).collect()
    assert {tuple(sorted((r.u % 2**64, r.v % 2**64))) for r in got} == want and len(got) == len(want)
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_golay_code():
    golay = simhash.golay()
    every = np.arange(1 << 23, dtype=np.uint32)
    assert np.bincount(golay.index(every), minlength=4096).tolist() == [2048] * 4096  # perfect: equal spheres
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500).astype(np.uint32)
    row, index = golay.near(words, 23)
    assert set(np.bincount(row).tolist()) == {1, 6}
    near = set(zip(row.tolist(), index.tolist()))
    for bit in range(23):
        assert all((k, i) in near for k, i in enumerate(golay.index(words ^ np.uint32(1 << bit)).tolist()))


def test_components_of_a_chain_a_hub_and_nothing(spark):
    chain = [(k, k + 1) for k in range(20)]
    hub = [(100, 100 + k) for k in range(1, 30)]
    got = components.connected_components(spark.createDataFrame([*chain, *hub, (7, 7), (3, 2)], "u long, v long")).collect()
    assert {(r.node, r.root) for r in got} == {(k, 0) for k in range(1, 21)} | {(100 + k, 100) for k in range(1, 30)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_removal(pairs, size):
    words = [(t or "").encode().split() for _, t in pairs]
    first = {}
    for (d, _), w in zip(pairs, words):
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            if d is not None:
                first[k] = min(d, first.get(k, d))
    out = []
    for (d, _), w in zip(pairs, words):
        gone = set()
        for p in range(len(w) - size + 1):
            if d is not None and first[tuple(w[p : p + size])] < d:
                gone.update(range(p, p + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def removed(docs, size):
    return sorted(map(tuple, substrings.remove_repeats(docs, substrings.digest_columns, substrings.DIGEST_SCHEMA, size).collect()), key=str)


def test_op5_against_brute_force(spark, sf_small):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert sorted(map(tuple, op5_substrings(spark, sf_small).collect())) == sorted(brute_removal(pairs, 50))


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_of_small_alphabets(spark, make_docs, seed):
    """Few distinct words: windows overlap, repeat inside a document, tie and chain."""
    rng = random.Random(seed)
    pairs = [(rng.randrange(40), " ".join(rng.choice("aab") for _ in range(rng.randrange(40)))) for _ in range(60)]
    pairs += [(d + 50, t) for d, t in pairs[:10]] + [(None, pairs[0][1]), (60, None), (61, "")]
    assert removed(make_docs(pairs).repartition(5), 6) == sorted(brute_removal(pairs, 6), key=str)


def test_substrings_of_odd_rows(spark, make_docs):
    assert removed(make_docs(ODD), 3) == sorted(brute_removal(ODD, 3), key=str)
    assert removed(make_docs([]), 50) == []
    carried = substrings.remove_repeats(make_docs(ODD), size=3, carry=True).collect()
    assert sorted(str((r.row.doc_id, r.row.text, r.row.ends)) for r in carried) == sorted(str((d, t, "e")) for d, t in ODD)


def brute_matches(docs, items, size=10):
    windows = set()
    for i, t in items:
        w = decontaminate.split_words((t or "").encode())
        windows |= {(("" if i is None else str(i)), tuple(w[p : p + size])) for p in range(max(1, len(w) - size + 1) if w else 0)}
    out = []
    for d, t in docs:
        w = decontaminate.split_words((t or "").encode())
        hit, found = set(), set()
        for i, k in windows:
            for p in range(len(w) - len(k) + 1):
                if tuple(w[p : p + len(k)]) == k:
                    hit.update(range(p, p + len(k)))
                    found.add(i)
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, "the the the the"), (2, None), (3, "Alpha, BETA! gamma"), (3, "Alpha, BETA! gamma"), (None, "w0x0 w1x0"), (4, "..."), (5, "alpha beta gamma delta never seen here at all in any text"), (10, "ß é́")]


def test_decontamination_of_odd_rows(spark, make_docs):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, term string")
    docs = [*ODD, (30, "Ok ALPHA-beta.Gamma ok"), (31, "alpha beta"), (32, "gamma alpha beta")]
    got = decontaminate.report(decontaminate.decontaminate(make_docs(docs), items)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_matches(docs, ITEMS), key=str)
    assert decontaminate.decontaminate(make_docs([]), items).count() == 0
    clean = decontaminate.report(decontaminate.decontaminate(make_docs(docs), items.limit(0))).collect()
    assert len(clean) == len(docs) and not any(r.contaminated for r in clean)


def test_proximity(spark, make_docs):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = make_docs([(1, "alpha x beta gamma"), (2, "alpha x y z beta gamma"), (3, "gamma beta alpha"), (4, "beta alpha beta q gamma"), (5, "alpha"), (6, "beta gamma")])
    got = decontaminate.decontaminate(docs, items, slop=1).collect()
    assert {r.doc_id: [(s.first, s.last) for s in r.spans] for r in got} == {1: [(0, 3)], 2: [], 3: [], 4: [(1, 4)], 5: [], 6: []}


def test_op3_against_brute_force(spark, sf_small):
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"{sf_small}/{t}.parquet").select(c, "text").collect()]
    want = brute_matches(read("documents", "doc_id"), read("benchmark", "item_id"))
    assert sorted(map(tuple, op3_decontaminate(spark, sf_small).collect())) == sorted(want)
    assert set(ORACLE) == {"op3_decontaminate", "op5_substrings"}
