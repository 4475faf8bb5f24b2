"""Centroid clustering in exact integers, with the equal-average equal-variance search.

A vector has whole-number components. For the search, centroids stand in the order of their mean,
and each vector looks at them outward from its own mean. With ``m`` the mean of ``dim`` components and
``v`` the length of what is left when the mean is taken off, two vectors are never closer than

    distance >= dim * (m - m')^2    and    distance >= dim * (m - m')^2 + (v - v')^2

so that a vector stops as soon as the first bound exceeds the best distance it has (all centroids
farther out are worse), and passes a centroid by where the second one does. What neither rejects gets its exact squared
distance in 64-bit integers; equal distances go to the smaller number. The first bound is
compared in integers as well, the second in floating point less a margin above its rounding error, so
that nothing that could win or tie is ever rejected.

Each round is one pass over the vectors: tasks add up their own vectors by cluster, and the driver gets
``centroids * dim`` sums. Vectors are read again in every round, not held.

Defined results: vectors that are null, have another number of components or a component that is null or
not finite are left out. Fewer vectors than centroids make fewer centroids; an empty table
gives no rows. Repeated rows are vectors of their own, and may become equal centroids (then the smaller
number gets all). A null vec_id hashes like an empty one and is returned. A component beyond
``LARGEST`` after scaling has no exact distance in 64 bits and is refused with an error. Columns other
than vec_id and embedding are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored

DIM, SCALE = 64, 64

#: Sums of 64 components up to this differ by less than 2^31.5, so that squares stay below 2^63.
LARGEST = 1 << 24

#: Share by which the bound in floating point is lowered; its rounding error is some 2^-48.
MARGIN = 1e-9

#: Vectors searched together.
BLOCK = 4_096

ASSIGNED = "vec_id long, cluster int, distance long, exact_distances int"


def kept(embeddings: DataFrame) -> DataFrame:
    """Vectors as they count: (vec_id, embedding) with ``DIM`` finite components."""
    fine = (F.size("embedding") == DIM) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose id hashes lowest; equal hashes in the order of their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(key, "embedding").limit(k).collect()
    return _whole_numbers(np.array([r.embedding for r in rows], dtype=np.float64).reshape(-1, DIM))


def _whole_numbers(values: np.ndarray) -> np.ndarray:
    scaled = np.floor(values * SCALE)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling: its distances do not fit 64 bits")
    return scaled.astype(np.int64)


class Search:
    """Nearest centroid of blocks of vectors."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.lexsort((np.arange(len(sums)), sums))  # place in the order of means -> number
        self.centroids, self.sums = centroids[self.number], sums[self.number]
        self.rest = _rest(self.centroids, self.sums)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, squared distance, centroids compared exactly) of every vector."""
        n, k = len(vectors), len(self.sums)
        sums = vectors.sum(axis=1)
        rest = _rest(vectors, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number, compared = np.full(n, k, dtype=np.int64), np.zeros(n, dtype=np.int32)
        at = np.arange(n)
        for _ in range(k):
            # Every vector that still searches takes the nearer of its two neighbours in the order.
            gap_left = np.where(left[at] >= 0, sums[at] - self.sums[left[at]], np.iinfo(np.int64).max)
            gap_right = np.where(right[at] < k, self.sums[np.minimum(right[at], k - 1)] - sums[at], np.iinfo(np.int64).max)
            go_left = gap_left <= gap_right
            place, gap = np.where(go_left, left[at], right[at]), np.minimum(gap_left, gap_right)
            left[at] -= go_left
            right[at] += ~go_left
            # Mean: gap^2 > dim * best, without leaving 64 bits.
            near = _ceil_div(gap * gap, DIM) <= best[at]
            at, place, gap = at[near], place[near], gap[near]
            if not len(at):
                break
            bound = (gap.astype(np.float64) ** 2 / DIM + (rest[at] - self.rest[place]) ** 2) * (1 - MARGIN)
            maybe = bound <= best[at]
            rows, places = at[maybe], place[maybe]
            apart = vectors[rows] - self.centroids[places]
            distance = np.einsum("ij,ij->i", apart, apart)
            compared[rows] += 1
            names = self.number[places]
            wins = (distance < best[rows]) | ((distance == best[rows]) & (names < number[rows]))
            best[rows[wins]], number[rows[wins]] = distance[wins], names[wins]
        return number, best, compared


def _ceil_div(a: np.ndarray, b: int) -> np.ndarray:
    return -(-a // b)


def _rest(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Length of each vector less its mean, from exact integers: dim * sum of squares - sum squared
    may pass 64 bits, so the squares are taken of dim * x - sum."""
    apart = (vectors * vectors.shape[1] - sums[:, None]).astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", apart, apart)) / vectors.shape[1]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK):
            part = batch.slice(a, BLOCK)
            values = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIM)
            yield part.column(0), _whole_numbers(values)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, np.ndarray]]:
    """Number of vectors and sums of their components by cluster."""

    def add(batches):
        search = Search(centroids)
        total, count = np.zeros(centroids.shape, dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
        for _, block in _blocks(batches):
            number, _, _ = search.nearest(block)
            order = np.argsort(number, kind="stable")
            held, starts = np.unique(number[order], return_index=True)
            total[held] += np.add.reduceat(block[order], starts, axis=0)
            count += np.bincount(number, minlength=len(centroids))
        held = np.flatnonzero(count)
        at = np.repeat(held, DIM)
        yield pa.RecordBatch.from_arrays([
            pa.array(at, pa.int32()), pa.array(np.tile(np.arange(DIM), len(held)), pa.int32()),
            pa.array(total[held].ravel(), pa.int64()), pa.array(count[at], pa.int64())], names=["cluster", "place", "total", "n"])

    parts = vectors.mapInArrow(add, "cluster int, place int, total long, n long")
    rows = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    out = {r.cluster: (r.n, [0] * DIM) for r in rows}
    for r in rows:
        out[r.cluster][1][r.place] = int(r.total)
    return out


def fit(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1) -> np.ndarray:
    """The centroids after ``rounds`` rounds. Means are rounded down exactly; an empty cluster's
    centroid stays."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        for cluster, (n, total) in _sums(vectors, centroids).items():
            centroids[cluster] = [t // n for t in total]
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, exact_distances) of every vector."""

    def nearest(batches):
        search = Search(centroids)
        for ids, block in _blocks(batches):
            number, distance, compared = search.nearest(block)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(number, pa.int32()), pa.array(distance, pa.int64()), pa.array(compared, pa.int32())],
                names=["vec_id", "cluster", "distance", "exact_distances"])

    return vectors.mapInArrow(nearest, ASSIGNED)


def clusters(embeddings: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """Every kept vector with its cluster, its squared distance, the sums of distances in its
    cluster and over all, a hash of its centroid, and how many centroids it was compared with."""
    vectors = kept(embeddings)
    centroids = fit(vectors, k, rounds, seed)
    found = stored(assign(vectors, centroids), "clusters")
    sums = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    if not sums:
        return found.selectExpr(
            "vec_id", "cluster", "distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256", "exact_distances")
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    own = F.array(*[F.lit(sums.get(c, 0)).cast("long") for c in range(len(centroids))])[F.col("cluster")]
    name = F.array(*map(F.lit, names))[F.col("cluster")]
    return found.select(
        "vec_id", "cluster", "distance", own.alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"),
        name.alias("centroid_sha256"), "exact_distances")
