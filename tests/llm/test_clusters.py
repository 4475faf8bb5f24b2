"""Centroid clustering against a plain recomputation."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemart.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "d", 0) for i, v in rows], SCHEMA)


def plain(rows, k=16, rounds=3):
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
             if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(whole, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in whole]
        for n in set(own):
            held = [v for (_, v), o in zip(whole, own, strict=True) if o == n]
            centroids[n] = [sum(column) // len(held) for column in zip(*held, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in whole]
    sums = {n: sum(d for _, c, d in found if c == n) for n in range(k)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums.values()), digest[c]) for i, c, d in found), key=repr)


def got(spark, rows):
    df = clusters.clusters(frame(spark, rows))
    assert df.columns[:-1] == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r)[:-1] for r in df.collect()), key=repr)


def vectors(n, seed=1, spread=1.0):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(20)]
    return [(i, [m + rnd.gauss(0, spread) for m in middles[rnd.randrange(20)]]) for i in range(n)]


@pytest.mark.parametrize("rows", [vectors(300), vectors(200, 2, 0.01), vectors(9), [(i, [float(i % 3)] * 64) for i in range(60)],
                                  [(i, [1e-3 * (i % 5 - 2)] * 63 + [0.0]) for i in range(40)], vectors(40) * 2])
def test_equal_to_brute_force(spark, rows):
    assert got(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = vectors(30) + [
        (100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [1.0] * 63 + [None]), (105, [float("nan")] + [0.0] * 63),
        (106, [float("inf")] * 64), (107, [-0.0] * 64), (None, [0.5] * 64), (None, [0.25] * 64), (-3, [200_000.0] + [0.0] * 63)]
    want = plain(rows)
    assert got(spark, rows) == want and len(want) == 34


def test_empty_tables(spark):
    assert got(spark, vectors(3)[:1]) == plain(vectors(3)[:1])
    assert clusters.clusters(frame(spark, vectors(1)).limit(0)).count() == 0
    assert clusters.clusters(frame(spark, [(1, [1.0])])).count() == 0


def test_a_component_without_exact_distance_is_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        clusters.clusters(frame(spark, [(1, [1e30] * 64)])).collect()


def test_the_search_rejects_and_is_exact():
    rnd = np.random.default_rng(5)
    centroids = rnd.integers(-300, 300, (64, 64)) + rnd.integers(-200, 200, (64, 1))
    block = np.concatenate([centroids[rnd.integers(0, 64, 500)] + rnd.integers(-20, 20, (500, 64)), centroids, centroids[::-1] + 1])
    number, distance, compared = clusters.Search(centroids).nearest(block)
    every = ((block[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert compared.mean() < 16 and compared.min() >= 1


def test_extremes_stay_within_64_bits():
    far = clusters.LARGEST
    centroids = np.array([[far] * 64, [-far] * 64, [far, -far] * 32], dtype=np.int64)
    number, distance, _ = clusters.Search(centroids).nearest(np.array([[-far] * 64, [far] * 64, [-far, far] * 32]))
    assert number.tolist()[:2] == [1, 0] and distance.tolist() == [0, 0, min(64 * far * far * 2, 64 * 4 * far * far)]
