"""Centroid clustering whose nearest-centroid search is the threshold algorithm.

For every dimension the centroids are kept sorted by their value in it. A vector starts at its
own value in every list and walks outward, taking the nearer of the two neighbours in each
list a step. A centroid met for the first time gets its exact squared distance. The frontier of a
list is the distance to its next neighbour, so a centroid not met yet is at least as far as the
sum of the squared frontiers; the walk stops once that sum strictly exceeds the best exact
distance (an equal sum could still hide a tie with a smaller number).

All arithmetic is on integers, so results don't depend on how rows are dealt. A round is one
pass over the vectors: tasks send one row of sums per centroid, and only centroids, k x
dimensions integers, reach the driver and travel back with the tasks. The integer vectors
are written once.

Edge cases: vectors that are null, of another length, or hold null or non-finite components
take no part and have no row. Repeated rows and ids are vectors of their own; a null id hashes
as the empty text, and equal hashes at the start are settled by the vector. With fewer than k
vectors each is a centroid. Empty tables give no rows. Other columns are not read. Components whose
integer exceeds 2^27 are refused with an error, as squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

DIMENSIONS = 64
CENTROIDS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
LARGEST = 1 << 27
FAR = np.int64(1 << 30)  # beyond any difference of two components


def threshold_nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each row; ties to the smaller."""
    n, k = len(x), len(centroids)
    dims = np.arange(centroids.shape[1])
    ids = np.argsort(centroids, axis=0, kind="stable")
    # A guard on either side stands for an exhausted direction.
    values = np.pad(np.take_along_axis(centroids, ids, axis=0), ((1, 1), (0, 0)))
    ids = np.pad(ids, ((1, 1), (0, 0)))
    best = np.full(n, np.iinfo(np.int64).max)
    number = np.full(n, k, dtype=np.int64)
    alive = np.arange(n)
    left = np.stack([np.searchsorted(values[1:-1, d], x[:, d]) for d in dims], axis=1) \
        if n else np.zeros(x.shape, np.int64)
    right = left + 1
    seen = np.zeros((n, k), dtype=bool)

    def gaps(rows, lo, hi):
        return (np.where(lo > 0, rows - values[lo, dims], FAR),
                np.where(hi <= k, values[hi, dims] - rows, FAR))

    while len(alive):
        rows = x[alive]
        below, above = gaps(rows, left, right)
        lower = below <= above
        met = np.where(lower, ids[left, dims], ids[right, dims])
        touched = np.zeros((len(alive), k), dtype=bool)
        touched[np.arange(len(alive))[:, None], met] = True
        fresh = touched & ~seen
        seen |= touched
        for c in np.flatnonzero(fresh.any(axis=0)):
            at = np.flatnonzero(fresh[:, c])
            gap = rows[at] - centroids[c]
            d = np.einsum("ij,ij->i", gap, gap)
            who = alive[at]
            better = (d < best[who]) | ((d == best[who]) & (c < number[who]))
            best[who[better]], number[who[better]] = d[better], c
        left, right = left - lower, right + ~lower
        # All lists end at the same step, when every centroid has been met.
        on = ~seen.all(axis=1)
        alive, left, right, seen = alive[on], left[on], right[on], seen[on]
        frontier = np.minimum(*gaps(x[alive], left, right))
        go = np.einsum("ij,ij->i", frontier, frontier) <= best[alive]
        alive, left, right, seen = alive[go], left[go], right[go], seen[go]
    return number, best


def integer_vectors(vectors: DataFrame, *, id_col: str, vector_col: str,
                    dimensions: int) -> DataFrame:
    """(id, v): vectors that take part, as floor(1024 * component)."""
    e = F.col(vector_col).cast("array<double>")
    bad = F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    scaled = F.transform(e, lambda c: F.when(
        F.abs(c) <= LARGEST / SCALE, F.floor(c * SCALE).cast("long")).otherwise(
        F.raise_error(F.lit("a component is too large for exact 64-bit distances")).cast("long")))
    return vectors.where((F.size(e) == dimensions) & ~F.coalesce(bad, F.lit(True))) \
        .select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))


def batch_matrix(column: pa.ListArray, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def cluster(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
            dimensions: int = DIMENSIONS, k: int = CENTROIDS, rounds: int = ROUNDS,
            seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every vector that takes part, final centroids)."""
    rows = cut(integer_vectors(vectors, id_col=id_col, vector_col=vector_col,
                               dimensions=dimensions))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = rows.select("v", F.sha2(named, 256).alias("h")).orderBy("h", "v").limit(k).collect()
    centroids = np.array([r.v for r in first], dtype=np.int64).reshape(len(first), dimensions)

    def sums_of(now: np.ndarray):
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(now.shape, dtype=np.int64)
            count = np.zeros(len(now), dtype=np.int64)
            for batch in batches:
                x = batch_matrix(batch.column(0), dimensions)
                number, _ = threshold_nearest(x, now)
                count += np.bincount(number, minlength=len(now))
                for c in np.unique(number):
                    total[c] += x[number == c].sum(axis=0)
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(count[at]),
                 pa.array([total[c] for c in at], pa.list_(pa.int64()))], names=["c", "n", "s"])
        return partial

    for _ in range(rounds if len(first) else 0):
        parts = rows.select("v").mapInArrow(sums_of(centroids), "c int, n long, s array<long>")
        wide = "decimal(38,0)"
        new = parts.select("c", "n", F.posexplode("s")).groupBy("c", "pos").agg(
            F.sum(F.col("col").cast(wide)).alias("s"), F.sum("n").alias("n")).collect()
        moved = centroids.copy()
        for r in new:
            moved[r.c, r.pos] = int(r.s) // r.n
        if np.array_equal(moved, centroids):
            break  # every later round would give the same
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, best = threshold_nearest(batch_matrix(batch.column(1), dimensions), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number.astype(np.int32)), pa.array(best)],
                names=["id", "cluster", "distance"])

    return rows.mapInArrow(assign, "id long, cluster int, distance long"), centroids


def clustered(vectors: DataFrame, **options) -> DataFrame:
    """Per vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    id_col = options.get("id_col", "vec_id")
    found, centroids = cluster(vectors, **options)
    found = cut(found)
    # One row per centroid: bounded by k.
    sums = {r["cluster"]: r["s"] for r in
            found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    inertia = sum(sums.values())
    rows = [(c, sums.get(c, 0), inertia, hashlib.sha256(
        ",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(centroids)]
    final = vectors.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(final), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256")
