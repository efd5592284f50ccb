"""Centroid clustering with lower bounds from Ptolemy's inequality over fixed pivot pairs.

For pivots p and s, Ptolemy's inequality bounds the distance of a vector x and a centroid c from below:
d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s). The pivots are the first centroids; a
vector's distances to them are worked out once and stored beside it, so later rounds test most
centroids by a few products. Each centroid has its own pairs, which hold the pivot that it began as:
while the centroid has moved little, the bound is close to the distance. Bounds are rounded down by
more than the error of their arithmetic; every centroid that a bound doesn't rule out is compared
exactly, so the result is that of comparing all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ulasan.session import stored

#: Components are held to this range, in which squared distances of 64 components are exact as doubles.
LARGEST = 1 << 22
#: A bound is lowered by this share of the numbers it is made of, some times the error of the operations.
SLACK = 64 * np.finfo(np.float64).eps
#: A centroid's pairs are its own pivot with the pivots this many places on.
STEPS = (1, 2, 5)


def grid(
    vectors: DataFrame, dims: int = 64, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """`(vec_id, v)` of the vectors of exactly `dims` finite components, as whole numbers floor(scale * x)."""
    x = F.col("x").cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("x"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(
        x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int")
    )
    return rows.where((F.size("x") == dims) & finite).select("vec_id", whole.alias("v"))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows; whole numbers as doubles."""
    diff = a - b
    return np.einsum("ij,ij->i", diff, diff)


@dataclass(frozen=True)
class Pivots:
    """The pivots and, for each centroid, the pairs of pivots that bound it."""

    points: np.ndarray
    pairs: list[list[tuple[int, int, float]]]

    @staticmethod
    def of(points: np.ndarray) -> Pivots:
        k = len(points)
        pairs: list[list[tuple[int, int, float]]] = []
        for j in range(k):
            others = sorted({(j + s) % k for s in STEPS} - {j})
            apart = [(j, s, float(np.sqrt(squared(points[j : j + 1], points[s : s + 1])[0]))) for s in others]
            pairs.append([p for p in apart if p[2] > 0])
        return Pivots(points, pairs)

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Of every row to every pivot."""
        return np.sqrt(np.stack([squared(x, p[None, :]) for p in self.points], axis=1)) if len(x) else np.zeros((0, len(self.points)))

    def squared_bounds(self, to_pivots: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """No entry is above the exact squared distance of its row and centroid."""
        own = self.distances(centroids)
        out = np.zeros((len(to_pivots), len(centroids)))
        for j, pairs in enumerate(self.pairs):
            for p, s, apart in pairs:
                a, b = to_pivots[:, p] * own[j, s], to_pivots[:, s] * own[j, p]
                np.maximum(out[:, j], (np.abs(a - b) - SLACK * (a + b)) / apart, out=out[:, j])
        return out * out * (1 - SLACK)


def nearest(x: np.ndarray, bounds: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (the smaller number on ties), its squared distance, and the number
    of exact comparisons."""
    who = bounds.argmin(axis=1)
    best = squared(x, centroids[who])
    guess, compared = who.copy(), len(x)
    for j in range(len(centroids)):
        rows = np.flatnonzero((bounds[:, j] <= best) & (guess != j))
        if len(rows):
            d = squared(x[rows], centroids[j][None, :])
            nearer = (d < best[rows]) | ((d == best[rows]) & (j < who[rows]))
            who[rows[nearer]], best[rows[nearer]] = j, d[nearer]
            compared += len(rows)
    return who, best, compared


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of their id; at most k short rows reach the driver."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.select(place.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.float64)


def with_pivot_distances(points: DataFrame, pivots: Pivots) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            found = pivots.distances(_matrix(b.column(1), np.float64))
            ends = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            to = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), to], ["vec_id", "v", "to_pivots"])

    kind = points.schema["vec_id"].dataType.simpleString()
    return points.mapInArrow(run, f"vec_id {kind}, v array<int>, to_pivots array<double>")


SUMS = "cluster int, place int, total long, n long, compared long"


def cluster_sums(points: DataFrame, pivots: Pivots, centroids: np.ndarray) -> DataFrame:
    """Sums of the components and number of vectors of each cluster; a task gives one row for each
    cluster and component, which Spark adds up."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, seen = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), 0
        for b in _blocks(batches):
            x = _matrix(b.column(0), np.float64)
            who, _, compared = nearest(x, pivots.squared_bounds(_matrix(b.column(1), np.float64), centroids), centroids)
            seen += compared
            n += np.bincount(who, minlength=k)
            for j in np.unique(who):
                total[j] += x[who == j].sum(axis=0).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(k, dtype=np.int32), dims)),
                pa.array(np.tile(np.arange(dims, dtype=np.int32), k)),
                pa.array(total.reshape(-1)),
                pa.array(np.repeat(n, dims)),
                pa.array(np.where(np.arange(k * dims) == 0, seen, 0)),
            ],
            ["cluster", "place", "total", "n", "compared"],
        )

    parts = points.select("v", "to_pivots").mapInArrow(run, SUMS)
    return parts.groupBy("cluster", "place").agg(*(F.sum(c).alias(c) for c in ("total", "n", "compared")))


def assigned(points: DataFrame, pivots: Pivots, centroids: np.ndarray) -> DataFrame:
    """`(vec_id, cluster, distance)` per vector; distance is the exact square."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            x = _matrix(b.column(1), np.float64)
            who, best, _ = nearest(x, pivots.squared_bounds(_matrix(b.column(2), np.float64), centroids), centroids)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(who.astype(np.int32)), pa.array(best.astype(np.int64))],
                ["vec_id", "cluster", "distance"],
            )

    kind = points.schema["vec_id"].dataType.simpleString()
    return points.select("vec_id", "v", "to_pivots").mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def moved(sums: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floors of the means; a cluster without vectors keeps its centroid. One short row for each
    cluster and component reaches the driver, which are parameters."""
    out = centroids.copy()
    for r in sums.where(F.col("n") > 0).collect():
        out[r["cluster"], r["place"]] = r["total"] // r["n"]
    return out


def cluster(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: float = 64.0,
    seed: int = 1,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """`(vec_id, cluster, distance)` per vector, and `(cluster, centroid, n, inertia)` per centroid.

    Vectors are those of exactly `dims` components, none null, NaN or infinite; a component x becomes
    floor(scale * x), held to +-2^22. The first centroids are the `k` vectors with the smallest sha256 of
    `seed:id`, of equal ids those with the smaller components, null ids last; fewer vectors give fewer
    centroids, none give empty tables. Each round assigns every vector to its nearest centroid (ties: the
    smaller number) and replaces the centroid of each cluster that has vectors by the floor of their mean.
    Equal vectors and repeated ids are rows of their own and each counts; other columns are not read,
    whatever their names. Every round is one scan of the stored vectors with one row for each task,
    cluster and component shuffled; only centroids reach the driver and are sent to the tasks, so no
    group of vectors is ever in one place. A lost executor's part of a scan is simply read again.
    """
    spark = vectors.sparkSession
    points = stored(grid(vectors, dims, scale, id_col, vec_col), "grid")
    centroids = first_centroids(points, k, seed)
    kind = points.schema["vec_id"].dataType.simpleString()
    summary = "cluster int, centroid array<long>, n long, inertia decimal(38,0)"
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), spark.createDataFrame([], summary)
    pivots = Pivots.of(centroids)
    points = stored(with_pivot_distances(points, pivots), "pivot-distances")
    for _ in range(rounds):
        centroids = moved(cluster_sums(points, pivots, centroids), centroids)
    found = stored(assigned(points, pivots, centroids), "clusters")
    known = spark.createDataFrame([(j, [int(x) for x in c]) for j, c in enumerate(centroids)], "cluster int, centroid array<long>")
    totals = found.groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(20,0)")).cast("decimal(38,0)").alias("inertia")
    )
    # One row for each of the k centroids.
    summary_rows = known.join(totals, "cluster", "left").select(
        "cluster", "centroid", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("inertia", F.lit(0)).cast("decimal(38,0)").alias("inertia")
    )
    return found, summary_rows
