import hashlib
import math
import random

import numpy as np
import pytest

from marketlake.llm import centroids, hard_negatives, vectors
from marketlake.llm.queries import op12_centroids, op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, ints string, row int, cluster string, block int, anchor string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, n, "x", 1, "y", 2, "z") for i, v, n in rows], SCHEMA)


def whole(v, factor, width=None):
    if v is None or any(x is None or not math.isfinite(x) for x in v) or (width is not None and len(v) != width):
        return None
    out = [math.floor(factor * float(np.float32(x))) for x in v]
    return None if any(abs(x) >= vectors.LIMIT for x in out) else out


def brute_clusters(rows, clusters, rounds, factor, width):
    kept = [(i, w) for i, v, _ in rows if (w := whole(v, factor, width)) is not None]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", np.array(r[1], "<i4").tobytes())
    middle = [w for _, w in sorted(kept, key=key)[:clusters]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(middle))
    for _ in range(rounds):
        of = [nearest(w)[1] for _, w in kept]
        for k in range(len(middle)):
            own = [w for (_, w), n in zip(kept, of) if n == k]
            if own:
                middle[k] = [sum(c) // len(own) for c in zip(*own)]
    found = [nearest(w) for _, w in kept]
    inertia = [sum(d for d, n in found if n == k) for k in range(len(middle))]
    return [(i, n, d, inertia[n], sum(inertia), hashlib.sha256(",".join(map(str, middle[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, found)]


def read(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


def test_op12_against_brute_force(spark, sf_small):
    got = op12_centroids(spark, sf_small).collect()
    assert sorted(map(tuple, got)) == sorted(brute_clusters(read(spark, sf_small), 8, 10, 1024, 64))


ODD = [(1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 0.0], 2), (5, [1.0], 1), (6, [1.0, 2.0, 3.0], 1), (7, [], 2),
       (8, [1e30, 0.0], 1), (None, [0.5, -0.5], 1), (None, [0.5, -0.5], None), (9, [0.1, 0.2], 1), (9, [0.1, 0.2], 1), (9, [0.3, 0.2], 2), (50, [0.25, 0.25], 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clusters_of_odd_rows_and_ties(spark, seed):
    rng = random.Random(seed)
    grid = lambda: [rng.choice([-1.0, -0.5, 0.0, 0.5, 1.0]) for _ in range(2)]
    rows = [*ODD, *[(100 + k, grid(), None) for k in range(80)]]
    got = centroids.cluster(table(spark, rows).repartition(4), 5, 4, factor=2, width=2).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_clusters(rows, 5, 4, 2, 2), key=str)


def test_few_vectors_and_none(spark):
    two = [(1, [1.0, 2.0], 0), (2, [3.0, 4.0], 0)]
    assert sorted(map(tuple, centroids.cluster(table(spark, two), width=2).collect())) == sorted(brute_clusters(two, 8, 10, 1024, 2))
    assert centroids.cluster(table(spark, []), width=2).count() == 0
    assert centroids.cluster(table(spark, ODD[:4]), width=64).collect() == []


def test_search_is_exact_and_skips(rng=np.random.default_rng(4)):
    for scale in (3, 1000, vectors.LIMIT - 1):
        rows = rng.integers(-scale, scale, (40, 16))
        x = np.concatenate([rng.integers(-scale, scale, (300, 16)), rows, np.clip(rows + 1, -scale, scale)])
        rows = np.concatenate([rows, rows[:3]])  # equal centroids: the smaller number
        number, distance, measured = centroids.Centroids(rows.tolist()).nearest(x)
        every = np.square(x[:, None].astype(object) - rows[None].astype(object)).sum(axis=2)
        assert number.tolist() == [min(range(len(rows)), key=lambda k: (d[k], k)) for d in every]
        assert distance.tolist() == [min(d) for d in every]
    near = np.repeat(np.arange(40)[:, None] * 100, 16, axis=1)
    assert centroids.Centroids(near.tolist()).nearest(near + rng.integers(-9, 9, near.shape))[2] < 40 * 6


def brute_negatives(rows, anchor, positives=5, negatives=3, least=50, most=95, factor=256):
    kept = [(hard_negatives.LAST if i is None else i, w, n) for i, v, n in rows if n is not None and (w := whole(v, factor)) is not None]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    real = lambda i: None if i == hard_negatives.LAST else i
    out = []
    for k, (i, w, n) in enumerate(kept):
        if real(i) is None or not anchor(i):
            continue
        scored = sorted((-dot(w, o), j, m != n) for at, (j, o, m) in enumerate(kept) if at != k)
        for ps, j, _ in [s for s in scored if not s[2]][:positives]:
            fit = [(-ns, o) for ns, o, differs in scored if differs and least * -ps <= 100 * -ns <= most * -ps][:negatives]
            out += [(i, real(j), rank, real(o), -ps, ns) for rank, (ns, o) in enumerate(fit, 1)]
    return out


def test_op13_against_brute_force(spark, sf_small):
    rows = [(i, v, (n + 1) % 10 if n is not None and i % 7 == 0 else n) for i, v, n in read(spark, sf_small)]
    want = brute_negatives(rows, lambda i: i % 50 == 0)
    assert sorted(map(tuple, op13_hard_negatives(spark, sf_small).collect())) == sorted(want) and len(want) > 20


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives_of_odd_rows_and_ties(spark, seed):
    rng = random.Random(seed)
    rows = [*ODD, *[(20 + k, [rng.choice([0.0, 0.5, 1.0, 1.5, 2.0]) for _ in range(3)], rng.choice([1, 1, 2, 3])) for k in range(70)], (200, [0.0, 0.0, 0.0], 7)]
    df = table(spark, rows)
    got = hard_negatives.mine(df, df.vec_id % 10 == 0, factor=4).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_negatives(rows, lambda i: i % 10 == 0, factor=4), key=str) and got
    empty = table(spark, [])
    assert hard_negatives.mine(empty, empty.vec_id % 10 == 0).count() == 0


def test_products_beyond_doubles():
    a = np.array([[vectors.LIMIT - 1, 3, 5]], np.int64)
    assert vectors.products(a, a[:, :2])[0, 0] == (vectors.LIMIT - 1) ** 2 + 9
