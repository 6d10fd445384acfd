"""K-Means on unit vectors: one group count through MLlib, a whole sweep in shared scans.

A sweep would scan the table once per iteration and group count. Here every scan serves all counts
(and all prefix lengths of the vectors) that have not converged yet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgroups.functions.arrays import lists, matrix, unit, unit_matrix, vector_sum
from docgroups.operators.seeds import first_rows, spread
from docgroups.session import BROADCAST_BYTES, row_bytes

TOLERANCE = 1e-4
STILL = 1e-20
FAR = 1e6  # coordinates of the centre of an empty group


def run_kmeans(vectors: DataFrame, k: int, seed: int = 42, max_iter: int = 300):
    """``(id, cluster)`` and the MLlib model. Zero rows take part, so the distance is Euclidean."""
    points = vectors.select("id", array_to_vector(unit(F.col("vec"))).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=TOLERANCE, predictionCol="cluster").fit(points)
    return model.transform(points).select("id", "cluster"), model


def nearest_centroid(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """``(id, cluster, dist2)``: nearest row of a ``(cluster, centroid)`` table, lowest cluster on ties.

    The table is a model, k rows; its size is checked before it is sent to the tasks.
    """
    if row_bytes(centroids) > BROADCAST_BYTES:
        raise ValueError("centroid table too large to send to every task")
    table = centroids.orderBy("cluster").collect()
    ids = np.array([r["cluster"] for r in table])
    centres = np.array([r["centroid"] for r in table], dtype=float)

    def assign(batches):
        for t in batches:
            if t.num_rows:
                x = matrix(t["vec"])
                d2 = _distances(x, centres)
                best = np.argmin(np.round(d2, 12), axis=1)
                yield pa.RecordBatch.from_pydict(
                    {"id": t["id"], "cluster": ids[best].astype(np.int32), "dist2": d2[np.arange(len(x)), best]}
                )

    return vectors.select("id", "vec").mapInArrow(assign, "id long, cluster int, dist2 double")


def inertia(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("dist2").alias("inertia"))


def class_centroids(vectors: DataFrame, label: str = "label") -> DataFrame:
    """Mean vector per label as a ``(cluster, centroid)`` table."""
    sums = vectors.groupBy(F.col(label).alias("cluster")).agg(
        vector_sum(F.col("vec")).alias("total"), F.count("*").alias("n")
    )
    return sums.select("cluster", F.transform("total", lambda x: x / F.col("n")).alias("centroid"))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2.0 * (x @ centres.T)
    return np.maximum(d2, 0.0)


def seed_rows(points: DataFrame, size: int, k: int, seed: int = 42) -> np.ndarray:
    """Up to ``k`` seeds (see ``seeds``) of rows cut to ``size`` and unit length; zero rows are left out.

    Rows that are equal in nine digits count as the one with the smallest id.
    """
    cut_rows = points.select("id", unit(F.slice("vec", 1, size)).alias("vec")).where(F.exists("vec", lambda x: x != 0))
    same = F.transform("vec", lambda x: F.round(x, 9))
    first = first_rows(cut_rows.groupBy(same.alias("same")).agg(F.min_by("vec", "id").alias("vec"), F.min("id").alias("id")).drop("same"), seed)
    x = np.array([r["vec"] for r in first]).reshape(-1, size)
    row, column = np.divmod(np.arange(x.size), size)
    return x[spread(np.array([r["id"] for r in first]), row, column, x.ravel(), k, seed)]


def _scan(points: DataFrame, active: dict) -> dict:
    """One shared Lloyd scan: per run and group the rows, cost and vector sum."""
    def partial(batches):
        acc = {}
        for t in batches:
            if not t.num_rows:
                continue
            full = matrix(t["vec"])
            for size in {key[0] for key in active}:
                x = unit_matrix(full[:, :size])
                for key, centres in active.items():
                    if key[0] != size:
                        continue
                    d2 = _distances(x, centres)
                    own = np.round(d2, 9).argmin(axis=1)
                    hot = np.zeros((len(centres), len(x)))
                    hot[own, np.arange(len(x))] = 1.0
                    cost = np.bincount(own, weights=d2[np.arange(len(x)), own], minlength=len(centres))
                    new = np.column_stack([hot.sum(axis=1), cost, hot @ x])
                    acc[key] = acc[key] + new if key in acc else new
        for (size, k), sums in acc.items():
            yield pa.RecordBatch.from_pydict({
                "size": np.full(len(sums), size, dtype=np.int32), "k": np.full(len(sums), k, dtype=np.int32),
                "c": np.arange(len(sums), dtype=np.int32), "sums": lists(sums),
            })

    parts = points.select("vec").mapInArrow(partial, "size int, k int, c int, sums array<double>")
    rows = parts.groupBy("size", "k", "c").agg(vector_sum(F.col("sums")).alias("sums")).collect()
    out = {key: np.zeros((len(centres), key[0] + 2)) for key, centres in active.items()}
    for r in rows:
        out[(r["size"], r["k"])][r["c"]] = r["sums"]
    return out


def fit_sweep(points: DataFrame, ks: list[int], sizes: list[int], seed: int = 42, max_iter: int = 300, tolerance: float = TOLERANCE) -> dict:
    """Centres and inertia per ``(size, k)``. ``points`` is ``(id, vec)``, read once per iteration.

    A run ends when its centres move by no more than ``tolerance`` times the mean variance; with 0 it ends when no row changes its group.
    A group that loses all its rows stays empty. The state on the driver is the centres, sum(ks) * sum(sizes) numbers.
    """
    if 8 * sum(ks) * sum(sizes) > BROADCAST_BYTES:
        raise ValueError("the sweep's centres exceed the broadcast bound; sweep fewer sizes at once")
    centres = {}
    for size in sizes:
        seeds = seed_rows(points, size, max(ks), seed)
        for k in ks:
            centres[(size, k)] = seeds[:k] if len(seeds) else np.zeros((1, size))
    costs, active, spread = {}, dict(centres), {}
    for _ in range(max_iter):
        sums = _scan(points, active)
        still = {}
        for key, s in sums.items():
            rows, old = s[:, :1], active[key]
            new = np.divide(s[:, 2:], rows, out=np.full_like(old, FAR), where=rows > 0)
            if key[0] not in spread:
                n, total = max(rows.sum(), 1.0), s[:, 2:].sum(axis=0)
                nonzero = s[:, 1].sum() + 2.0 * (old * s[:, 2:]).sum() - ((old * old).sum(axis=1) * s[:, 0]).sum()
                spread[key[0]] = (nonzero / n - ((total / n) ** 2).sum()) / key[0]
            centres[key], costs[key] = new, float(s[:, 1].sum())
            # What rounding alone moves is far below STILL, and a row that changes its group moves its centre by more.
            if ((new - old) ** 2).sum() > max(tolerance * spread[key[0]], STILL):
                still[key] = new
        active = still
        if not active:
            break
    final = _scan(points, centres)
    return {key: (centres[key], float(final[key][:, 1].sum())) for key in centres}


def label_sweep(points: DataFrame, fits: dict, size: int, ks: list[int]) -> DataFrame:
    """``(id, vec, labels)``: rows cut to ``size`` and unit length, with the group of each k."""
    centres = [fits[(size, k)][0] for k in ks]

    def assign(batches):
        for t in batches:
            if t.num_rows:
                x = unit_matrix(matrix(t["vec"])[:, :size])
                labels = np.stack([np.round(_distances(x, c), 9).argmin(axis=1) for c in centres], axis=1)
                yield pa.RecordBatch.from_pydict(
                    {"id": t["id"], "vec": lists(x), "labels": lists(labels.astype(np.int32))}
                )

    return points.select("id", "vec").mapInArrow(assign, "id long, vec array<double>, labels array<int>")
