import hashlib
import math

import numpy as np
import pytest
from corpusmill.llm import exponion
from corpusmill.llm.queries import table

SF = "/root/testdata/sf0.001"


def brute(rows, k=16, rounds=3):
    """Results in Python integers from all distances."""
    kept = []
    for vec, x in rows:
        if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) and abs(v) < 1 << 21 for v in x):
            kept.append((vec, [math.floor(64 * float(v)) for v in x]))
    named = sorted((hashlib.sha256(f"1:{v}".encode()).hexdigest(), x) for v, x in kept if v is not None)
    centroids = [x for _, x in named[:k]]
    if not centroids:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids)) for _, x in kept]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centroids)):
            group = [x for (_, x), (_, c) in zip(kept, own) if c == j]
            if group:
                centroids[j] = [sum(col) // len(group) for col in zip(*group)]
    own = assign()
    total = [sum(d for d, c in own if c == j) for j in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((v, c, d, total[c], sum(total), sha[c]) for (v, _), (d, c) in zip(kept, own)), key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, data):
    return spark.createDataFrame([(*d, "x", 1, 2.0) for d in data], "vec_id long, embedding array<double>, steps string, cluster int, upper double")


def test_matches_brute_force_on_given_vectors(spark):
    vectors = table(spark, SF, "embeddings")
    assert rows(exponion.clusters(vectors)) == brute([(r.vec_id, r.embedding) for r in vectors.collect()])


def test_ties_repeats_and_odd_vectors(spark):
    random = np.random.default_rng(5)
    grid = [(int(k), (random.integers(-1, 2, 64) / 64).tolist()) for k in range(150)]
    same = [(1000 + k, grid[0][1]) for k in range(40)] + [(2000, grid[1][1])] * 5 + [(3000, grid[k][1]) for k in range(3)]
    odd = [(5001, None), (5002, []), (5003, [0.5] * 63), (5004, [0.5] * 65), (5005, [0.5] * 63 + [None]), (5006, [0.5] * 63 + [float("nan")]), (5007, [float("inf")] * 64), (5008, [-float("inf")] + [0.0] * 63), (5009, [2.0**21] * 64), (5010, [1e308] * 64), (None, grid[3][1]), (None, [0.0] * 64)]
    data = grid + same + odd
    expected = brute(data)
    assert rows(exponion.clusters(frame(spark, data).repartition(5))) == expected
    assert rows(exponion.clusters(frame(spark, data).repartition(1))) == expected
    assert rows(exponion.clusters(frame(spark, same))) == brute(same)  # centroids that coincide
    large = [(k, (random.uniform(-1, 1, 64) * 2.0**17).tolist()) for k in range(60)]  # products beyond doubles
    assert rows(exponion.clusters(frame(spark, large))) == brute(large)
    huge = [(k, (random.uniform(-1, 1, 64) * 2.0**20.9).tolist()) for k in range(60)]
    got, expected = exponion.clusters(frame(spark, huge)).collect(), brute(huge)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(r[:3] for r in expected)
    assert {r.inertia for r in got} == {None} and expected[0][4] >= 1 << 63


def test_few_or_no_vectors(spark):
    data = [(1, [0.1] * 64), (2, [0.7] * 64), (3, [0.1] * 64)]
    for n in (1, 2, 3):
        assert rows(exponion.clusters(frame(spark, data[:n]))) == brute(data[:n])
    assert rows(exponion.clusters(frame(spark, data).limit(0))) == []
    assert rows(exponion.clusters(frame(spark, [(None, [0.1] * 64)]))) == []


@pytest.mark.parametrize("seed", range(8))
def test_search_is_exact_and_scans_part_of_the_centroids(seed):
    random = np.random.default_rng(seed)
    centers = random.integers(-400, 400, (24, 64))
    spread = 5 if seed % 2 else 300
    vectors = centers[random.integers(0, 24, 3000)] + random.integers(-spread, spread + 1, (3000, 64))
    known = exponion.Centroids(vectors[:24].copy(), np.zeros(24))
    own, upper, lower = exponion.first_search(vectors, known)
    scans = 0
    for _ in range(6):
        after = known.rows.copy()
        for c in range(24):
            if (own == c).any():
                after[c] = vectors[own == c].sum(axis=0) // (own == c).sum()
        known = exponion.Centroids(after, exponion.moves(known.rows, after))
        own, upper, lower, scanned = exponion.search(vectors, own, upper, lower, known)
        distances = ((vectors[:, None, :] - after[None]) ** 2).sum(axis=2)
        assert (own == distances.argmin(axis=1)).all()  # argmin: the smallest number among equals
        exact = np.sqrt(distances.astype(float))
        assert (upper >= exact[np.arange(3000), own] * (1 - 1e-9)).all()
        exact[np.arange(3000), own] = np.inf
        assert (lower <= exact.min(axis=1) * (1 + 1e-9)).all()
        scans += scanned
    assert scans < 6 * 3000 * 24 * (0.25 if spread == 5 else 1)
