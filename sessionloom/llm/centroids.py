"""Centroid clustering of integer vectors, searched through Ptolemaic pivots.

For points q, c and a pair of pivots p, r, Ptolemy's inequality gives

    d(q, c) * d(p, r) >= | d(q, p) * d(c, r) - d(q, r) * d(c, p) |.

1. ``kept`` vectors get integer components, and their distances to a few fixed pivots (the
   first distinct starting centroids) are written next to them once: the cache.
2. In a round the driver holds only the centroids and their pivot distances. Every vector's
   lower bounds come from the cache, over all pairs of pivots; they are rounded down by more
   than the arithmetic can err. The centroid with the least bound is tried exactly, and then
   every centroid whose bound does not exceed that distance. Exact distances are 64-bit
   integers; ties go to the smaller number.
3. Tasks add up their vectors per cluster, so a round sends centroids x tasks narrow rows,
   and the driver gets one row per centroid and component. Sums are decimals, their floor exact.

Vectors stay where they are: no round shuffles or writes them. The only table written holds
the kept vectors, and lost executors cost tasks.

Defined results: a vector is kept if it has exactly ``dimensions`` components, none null, NaN,
infinite or, after scaling, beyond 2^27 (so that a squared distance fits 64 bits). Rows that
repeat a vec_id are vectors of their own; equal hashes are ordered by components. A null vec_id
counts as an empty text in the hash. With fewer vectors than centroids there are that many
centroids; an empty table gives no rows. Sums that pass 64 bits are null. Other columns do not
matter and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sessionloom.llm.common import col
from sessionloom.session import Staging

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1
PIVOTS = 5
WIDEST = 1 << 27
#: Relative slack of a bound; double arithmetic errs by less than 2^-49 of the products here.
SLACK = 2.0**-40


def scaled(vector: Column, dimensions: int = DIMENSIONS, scale: int = SCALE) -> Column:
    """The vector's integer components, null if it is not kept."""
    wide = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    sound = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < WIDEST // scale))
    return F.when((F.size(vector) == dimensions) & sound, wide.cast("array<int>"))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of ``x`` and ``y`` (or one vector ``y``)."""
    d = x.astype(np.int64) - y
    return np.einsum("ij,ij->i", d, d)


class Pivots:
    """Lower bounds on the distances between vectors and centroids from their distances to fixed points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.pairs = list(combinations(range(len(points)), 2))
        self.apart = self.distances(points)

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([squared(x, p) for p in self.points], axis=1).astype(np.float64)) if len(x) else np.empty((0, len(self.points)))

    def bounds(self, cached: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
        """For vectors (rows) and centroids (columns), distances that are never above the true ones."""
        low = np.zeros((len(cached), len(of_centroids)))
        for p, r in self.pairs:
            one = cached[:, p, None] * of_centroids[None, :, r]
            two = cached[:, r, None] * of_centroids[None, :, p]
            np.maximum(low, (np.abs(one - two) - (one + two) * SLACK) / (self.apart[p, r] * (1 + SLACK)), out=low)
        return low


def nearest(x: np.ndarray, cached: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of every vector's nearest centroid, and how many distances were computed."""
    low = pivots.bounds(cached, pivots.distances(centroids))
    rows, first = np.arange(len(x)), low.argmin(axis=1)
    exact = np.full(low.shape, np.iinfo(np.int64).max)
    exact[rows, first] = squared(x, centroids[first])
    reach = np.sqrt(exact[rows, first].astype(np.float64)) * (1 + SLACK)
    open_ = low * (1 - SLACK) <= reach[:, None]
    open_[rows, first] = False
    for c in range(len(centroids)):
        at = np.flatnonzero(open_[:, c])
        if len(at):
            exact[at, c] = squared(x[at], centroids[c])
    best = exact.argmin(axis=1)  # the first of equal ones
    return best, exact[rows, best], len(x) + int(open_.sum())


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


class Clustering:
    """Lloyd's rounds over the kept vectors of one table."""

    def __init__(self, vectors: DataFrame, stage: Staging, centroids: int = CENTROIDS, dimensions: int = DIMENSIONS,
                 scale: int = SCALE, seed: int = SEED, pivots: int = PIVOTS, vec_id: str = "vec_id", vector: str = "embedding"):
        self.stage, self.dimensions = stage, dimensions
        rows = vectors.select(col(vec_id).cast("long").alias("vec_id"), scaled(col(vector), dimensions, scale).alias("v")).filter("v is not null")
        spot = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
        first = rows.select("v", spot.alias("spot")).orderBy("spot", "v").limit(centroids).collect()
        self.centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, dimensions)
        apart = sorted(set(np.unique(self.centroids, axis=0, return_index=True)[1].tolist()))[:pivots] if first else []
        self.pivots = Pivots(self.centroids[apart])
        self.kept = stage.put("kept", self._cached(rows))

    def _cached(self, rows: DataFrame) -> DataFrame:
        """``vec_id, v, d``: every kept vector with its distances to the pivots."""
        pivots, dimensions = self.pivots, self.dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                d = pivots.distances(_matrix(batch.column(1), np.int64).reshape(-1, dimensions))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(d), pa.list_(pa.float64()))], names=["vec_id", "v", "d"])

        return rows.mapInArrow(run, "vec_id long, v array<int>, d array<double>")

    def _search(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = _matrix(batch.column(1), np.int64)
        best, distance, _ = nearest(x, _matrix(batch.column(2), np.float64), self.centroids, self.pivots)
        return x, best, distance

    def _task_state(self) -> "Clustering":
        """What a task needs: centroids and pivots, without the session."""
        new = object.__new__(Clustering)
        new.centroids, new.pivots = self.centroids, self.pivots
        return new

    def step(self) -> None:
        """Replace every non-empty centroid by the floor of its vectors' mean."""
        state = self._task_state()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k, width = state.centroids.shape
            sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, best, _ = state._search(batch)
                for c in np.unique(best):
                    mine = x[best == c]
                    sums[c] += mine.sum(axis=0)
                    counts[c] += len(mine)
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "c": pa.array(used, pa.int32()), "n": pa.array(counts[used], pa.int64()),
                "s": pa.array(list(sums[used]), pa.list_(pa.int64()))})

        parts = self.kept.mapInArrow(run, "c int, n long, s array<long>")
        total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
        found = parts.select("c", "n", F.posexplode("s").alias("i", "x")).groupBy("c", "i").agg(total("x").alias("x"), total("n").alias("n")).collect()
        moved = self.centroids.copy()
        for r in found:
            moved[r["c"], r["i"]] = int(r["x"]) // int(r["n"])
        self.centroids = moved

    def assigned(self) -> DataFrame:
        """``vec_id, cluster, distance``, staged."""
        state = self._task_state()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    _, best, distance = state._search(batch)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array(best, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

        return self.stage.put("assigned", self.kept.mapInArrow(run, "vec_id long, cluster int, distance long"))


def cluster(vectors: DataFrame, stage: Staging, rounds: int = ROUNDS, **options) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector."""
    run = Clustering(vectors, stage, **options)
    for _ in range(rounds if len(run.centroids) else 0):
        run.step()
    found = run.assigned()
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # one row per centroid
    whole = sum(int(r["s"]) for r in sums)
    fits = lambda n: n if n < 1 << 63 else None
    facts = [
        (r["cluster"], fits(int(r["s"])), fits(whole), hashlib.sha256(",".join(map(str, run.centroids[r["cluster"]].tolist())).encode()).hexdigest())
        for r in sums
    ]
    named = found.sparkSession.createDataFrame(facts, T.StructType([
        T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
        T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())]))
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
