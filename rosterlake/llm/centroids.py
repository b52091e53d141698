"""Centroid clustering of vectors with Orchard's nearest-centroid search.

Every centroid keeps the other centroids sorted by their distance from it. A
vector's search walks the list of the best centroid it knows; a centroid not
yet visited is measured and marked, and one that is nearer takes over with its
own list. A list entry strictly beyond twice the current distance ends the
search: by the triangle inequality it and all that follow are farther. All
numbers are integers, so distances, sums and ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import ready
from rosterlake.session import cut

K = 16
ROUNDS = 3
SIZE = 64
SCALE = 64
SEED = 1
LIMIT = 1 << 26           # a component beyond this could not be measured in 64 bits
STRETCH = 8192            # vectors searched side by side


class Orchard:
    """Centroids, their distances and neighbour lists; bounded by k squared."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        gap = self.centroids[:, None, :] - self.centroids[None, :, :]
        self.between = (gap * gap).sum(axis=2)
        number = np.arange(len(centroids))
        self.lists = np.array([np.lexsort((number, d)) for d in self.between],
                              np.int64).reshape(len(centroids), -1)

    def nearest(self, vectors: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """(centroid, squared distance) of each vector, of equally near ones the
        smaller number, and how many distances were measured."""
        n, k = len(vectors), len(self.centroids)
        best = np.full(n, start, np.int64)
        far = ((vectors - self.centroids[start]) ** 2).sum(axis=1)
        visited = np.zeros((n, k), bool)
        visited[:, start] = True
        at = np.zeros(n, np.int64)
        live = np.arange(n)
        measured = n
        while len(live):
            live = live[at[live] < k]
            other = self.lists[best[live], at[live]]
            # squares: beyond twice the distance is beyond four times its square
            near = self.between[best[live], other] <= 4 * far[live]
            live, other = live[near], other[near]
            at[live] += 1
            fresh = ~visited[live, other]
            who, which = live[fresh], other[fresh]
            visited[who, which] = True
            measured += len(who)
            d = ((vectors[who] - self.centroids[which]) ** 2).sum(axis=1)
            won = (d < far[who]) | ((d == far[who]) & (which < best[who]))
            who = who[won]
            best[who], far[who], at[who] = which[won], d[won], 0
        return best, far, measured


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _searched(orchard: Orchard, vectors: np.ndarray):
    for first in range(0, len(vectors), STRETCH):
        part = vectors[first:first + STRETCH]
        best, far, _ = orchard.nearest(part)
        yield part, best, far


def _sums(orchard: Orchard, size: int):
    """Count and componentwise sum of each centroid's vectors in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(orchard.centroids)
        total, count = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for part, best, _ in _searched(orchard, _matrix(batch.column(0), size)):
                np.add.at(total, best, part)
                count += np.bincount(best, minlength=k)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(held, size).astype(np.int32)),
             pa.array(np.tile(np.arange(size, dtype=np.int32), len(held))),
             pa.array(total[held].ravel()), pa.array(np.repeat(count[held], size))],
            ["cluster", "place", "total", "n"])
    return run


def _assign(orchard: Orchard, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_searched(orchard, _matrix(batch.column(1), size)))
            best = np.concatenate([b for _, b, _ in found] or [np.zeros(0, np.int64)])
            far = np.concatenate([d for _, _, d in found] or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best.astype(np.int32)), pa.array(far)],
                ["vec_id", "cluster", "distance"])
    return run


def whole_vectors(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding",
                  size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): vectors of exactly ``size`` finite components as integers
    ``floor(scale * x)``; rows with another length or a null, NaN or infinite
    component, or one beyond ``LIMIT``, are not kept."""
    made = vectors.select(F.col(id_).cast("long").alias("vec_id"), F.transform(
        F.col(vector), lambda x: x.cast("double") * F.lit(float(scale))).alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(float(LIMIT))))
    return made.where((F.size("v") == size) & sound).select(
        "vec_id", F.transform("v", lambda x: F.floor(x).cast("int")).alias("v"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of seed and id. Rows that share
    an id are ordered by their components; a null id counts as empty text."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    size = centroids.shape[1]
    parts = kept.select("v").mapInArrow(_sums(Orchard(centroids), size),
                                        "cluster int, place int, total long, n long")
    new = centroids.copy()
    # k times size rows at most
    for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total"),
                                                   F.sum("n").alias("n")).collect():
        new[r["cluster"], r["place"]] = r["total"] // r["n"]
    return new


def cluster_vectors(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", k: int = K,
                    rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED
                    ) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared, to its
    centroid), cluster_inertia, inertia and centroid_sha256.

    Each round reads the kept vectors once and brings back one sum per centroid
    and component; only the centroids travel, and no vector is shuffled.

    Vectors of another length and those with null, NaN, infinite or very large
    components are left out (see ``whole_vectors``). Repeated rows are vectors
    of their own and a null id is an id; fewer than ``k`` kept vectors are as
    many centroids; equal centroids: the smaller number takes all, the other
    stays where it is. Other columns are ignored; no kept vector, no row.
    """
    spark = ready(vectors.sparkSession)
    kept = cut(whole_vectors(vectors, id_, vector, size, scale))
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, "
                                         "cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = _moved(kept, centroids)
    found = cut(kept.mapInArrow(_assign(Orchard(centroids), size),
                                "vec_id long, cluster int, distance long"))
    inertia = {r["cluster"]: r["d"] for r in
               found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame(
        [(c, d, sum(inertia.values()), names[c]) for c, d in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # at most k rows
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
