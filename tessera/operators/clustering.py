"""Monte Carlo Pi, Lloyd k-means and Spark ML k-means.

Lloyd's loop keeps the K x D centres on the driver (model-sized).  Each
iteration is ONE pass over the packed points: every task assigns its matrices
to the nearest centre with numpy (strict ``<``: lowest index on ties) and emits
its per-cluster counts and coordinate sums as one row, added in a tree.  No data
row is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .blocks import Blocks, blocks_of
from .sampling import take_sample


def pi_estimate(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """4 * share of points strictly inside the unit circle."""
    inside = (F.col(x) * F.col(x) + F.col(y) * F.col(y) < 1).cast("long")
    return points.agg(F.count(F.lit(1)).alias("n"), F.sum(inside).alias("inside"),
                      (F.lit(4.0) * F.sum(inside) / F.count(F.lit(1))).alias("pi"))


def vector_dims(df: DataFrame, features: str) -> int:
    return int(df.select(F.size(features)).first()[0])


def kmeans_lloyd(df: DataFrame, k: int, converge_dist: float = 0.001, features: str = "features",
                 initial_centers: Sequence[Sequence[float]] | None = None, id_cols: Sequence[str] | None = None,
                 seed: int = 42, max_iter: int = 100) -> tuple[list[list[float]], int]:
    """Lloyd's algorithm.  Seeds: ``initial_centers`` or an exact sample of
    K rows (without replacement, by row hash).  Loop while the summed
    squared centre movement exceeds ``converge_dist`` (the movement starts
    at 1.0, so ``converge_dist >= 1`` runs no iteration) and at most
    ``max_iter`` times.  An empty cluster keeps its previous centre.
    Returns ``(centres, iterations)``."""
    pts = df.select(V.to_double_array(features).alias("f"), *(id_cols or []))
    if initial_centers is None:
        if not id_cols:
            raise ValueError("id_cols are needed to draw the initial centres")
        seeds = take_sample(pts, k, list(id_cols), with_replacement=False, seed=seed).collect()
        centers = [list(r["f"]) for r in seeds]
    else:
        centers = [list(map(float, c)) for c in initial_centers]
    k = len(centers)
    d = len(centers[0])
    pts = Blocks(pts.select("f"), {"f": d})
    delta, it = 1.0, 0
    try:
        while delta > converge_dist and it < max_iter:
            counts, sums = cluster_sums(pts, centers, "f")
            new = [list(c) for c in centers]
            for c in range(k):
                if counts[c] > 0:                      # an empty cluster keeps its centre
                    new[c] = (sums[c] / counts[c]).tolist()
            delta = sum(sum((a - b) ** 2 for a, b in zip(centers[i], new[i])) for i in range(k))
            centers = new
            it += 1
    finally:
        pts.unpersist()
    return centers, it


def assign_nearest(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centre (lowest on ties) and its squared distance,
    one centre at a time so memory stays O(rows x D)."""
    best = np.full(len(X), np.inf)
    arg = np.zeros(len(X), dtype=np.int64)
    for c in range(len(C)):
        diff = X - C[c]
        dist = (diff * diff).sum(axis=1)
        better = dist < best
        best[better] = dist[better]
        arg[better] = c
    return arg, best


def cluster_sums(pts: DataFrame | Blocks, centers: Sequence[Sequence[float]], features: str = "f") -> tuple[np.ndarray, np.ndarray]:
    """Per-cluster point counts and coordinate sums for the nearest-centre
    assignment: one pass over the packed points, one row per task."""
    C = np.asarray(centers, dtype=float)
    k, d = C.shape
    blocks, own = blocks_of(pts, {features: d})

    def task(ms):
        out = np.zeros((k, d + 1))
        for (X,) in ms:
            a, _ = assign_nearest(X, C)
            hot = np.zeros((k, len(X)))
            hot[a, np.arange(len(X))] = 1.0
            out[:, 0] += hot.sum(axis=1)
            out[:, 1:] += hot @ X
        return out.ravel()
    try:
        out = blocks.sums(task).reshape(k, d + 1)
    finally:
        if own:
            blocks.unpersist()
    return out[:, 0], out[:, 1:]


def kmeans_cost(df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """Sum over points of the squared distance to the nearest centre."""
    return df.agg(F.sum(V.nearest_center_dist(V.to_double_array(features), centers)).alias("cost"))


def kmeans_ml(df: DataFrame, k: int, max_iter: int = 10, init_mode: str = "k-means||",
              features: str = "features", seed: int = 42):
    """Spark ML k-means (k-means|| or random initialisation); returns the
    fitted model (``summary.trainingCost`` is the total cost)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    vec = df.select(array_to_vector(V.to_double_array(features)).alias("features"))
    km = KMeans(k=k, maxIter=max_iter, initMode=init_mode, seed=seed, featuresCol="features")
    return km.fit(vec)
