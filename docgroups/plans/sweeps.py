"""Sweeps over group counts and vector sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgroups.operators.kmeans import TOLERANCE, fit_sweep, label_sweep
from docgroups.operators.kselect import best_k_by_silhouette
from docgroups.operators.linkage import average_merges, cut_merges
from docgroups.operators.reduce import first_components
from docgroups.operators.scores import score_groups
from docgroups.operators.silhouette import mean_silhouettes
from docgroups.session import cut

SIZE = "n_components"
# The sizes that are compared.
COMPONENT_SIZES = (2, 5, 10, 20, 50, 100, 200, 300)


def width_of(vectors: DataFrame) -> int:
    return len(vectors.select("vec").first()[0])


def long_labels(grouped: DataFrame, ks: list[int], size: int, truth: DataFrame | None = None) -> DataFrame:
    """``(n_components, k, id, cluster)`` from one label array per row; with ``truth`` also ``label``,
    joined once per row and not once per grouping."""
    counts = F.array(*[F.lit(k) for k in ks])
    known = ["id"] if truth is None else ["id", "label"]
    grouped = grouped if truth is None else grouped.join(truth.select("id", "label"), "id")
    rows = grouped.select(*known, F.posexplode("labels").alias("g", "cluster"))
    return rows.select(F.lit(size).alias(SIZE), F.get(counts, F.col("g")).alias("k"), *known, "cluster")


def _silhouettes(grouped: DataFrame, ks: list[int], method: str, size: int) -> DataFrame:
    counts = F.array(*[F.lit(k) for k in ks])
    means = mean_silhouettes(grouped, ks, method)
    return means.select(F.lit(size).alias(SIZE), F.get(counts, F.col("g")).alias("k"), "silhouette")


def kmeans_sweep(
    vectors: DataFrame, ks: list[int], sizes: list[int] | None = None, seed: int = 42,
    method: str = "euclidean", truth: DataFrame | None = None, tolerance: float = TOLERANCE,
) -> tuple[DataFrame, DataFrame]:
    """``(n_components, k, inertia, silhouette)`` and the assignments ``(n_components, k, id, cluster)``.

    ``method`` is the silhouette: ``euclidean`` is exact and quadratic in the rows, ``squared`` one scan.
    """
    ks = list(ks)
    sizes = list(sizes or [width_of(vectors)])
    points = cut(vectors.select("id", "vec"))
    fits = fit_sweep(points, ks, sizes, seed, tolerance=tolerance)
    scores, labels = [], []
    for size in sizes:
        grouped = cut(label_sweep(points, fits, size, ks))
        scores.append(_silhouettes(grouped, ks, method, size))
        labels.append(long_labels(grouped, ks, size, truth))
    spark = vectors.sparkSession
    costs = spark.createDataFrame(
        [(size, k, fits[(size, k)][1]) for size in sizes for k in ks], f"{SIZE} int, k int, inertia double"
    )
    sweep = costs.join(reduce(DataFrame.unionByName, scores), [SIZE, "k"])
    return cut(sweep.select(SIZE, "k", "inertia", "silhouette")), reduce(DataFrame.unionByName, labels)


def agglomerative_sweep(vectors: DataFrame, ks: list[int], sizes: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(n_components, k, silhouette)`` and the assignments; one merge table per size serves every k."""
    ks = list(ks)
    sizes = list(sizes or [width_of(vectors)])
    points = cut(vectors.select("id", "vec"))
    runs = reduce(
        DataFrame.unionByName,
        [first_components(points, size).select(F.lit(size).alias("run"), "id", "vec") for size in sizes],
    )
    labels = cut(cut_merges(runs, average_merges(runs), ks))
    scores, every = [], []
    for size in sizes:
        mine = labels.where(F.col("run") == size).select("id", "labels")
        grouped = cut(first_components(points, size).join(mine, "id"))
        scores.append(_silhouettes(grouped, ks, "cosine", size))
        every.append(long_labels(grouped, ks, size))
    return cut(reduce(DataFrame.unionByName, scores)), reduce(DataFrame.unionByName, every)


def scored_sweep(
    vectors: DataFrame, truth: DataFrame, ks: list[int], sizes: list[int] | None = None,
    seed: int = 42, method: str = "euclidean", tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(n_components, k, inertia, silhouette, nmi, ari, ami)`` for ``truth`` ``(id, label)``."""
    sweep, labels = kmeans_sweep(vectors, ks, sizes, seed, method, truth, tolerance)
    scores = score_groups(labels, keys=(SIZE, "k"))
    joined = sweep.join(scores.select(SIZE, "k", "nmi", "ari", "ami"), [SIZE, "k"])
    return cut(joined.select(SIZE, "k", "inertia", "silhouette", "nmi", "ari", "ami"))


def component_sweep(
    vectors: DataFrame, sizes=COMPONENT_SIZES, ks=range(2, 31), seed: int = 42, method: str = "euclidean",
) -> DataFrame:
    """Best k and silhouette of both algorithms per size; NULL where no k has a silhouette.

    ``vectors`` hold the largest size. ``reduced_corpus`` and ``allowed_sizes`` tell which sizes a corpus can
    give; one beyond the vectors is an error.
    """
    sizes, width = sorted(set(sizes)), width_of(vectors)
    if not sizes or sizes[-1] > width:
        raise ValueError(f"sizes {sizes} do not fit vectors of {width} entries")
    out = vectors.sparkSession.createDataFrame([(s,) for s in sizes], f"{SIZE} int")
    for name, sweep in (
        ("kmeans", kmeans_sweep(vectors, list(ks), sizes, seed, method)[0]),
        ("agglomerative", agglomerative_sweep(vectors, list(ks), sizes)[0]),
    ):
        best = best_k_by_silhouette(sweep, (SIZE,)).withColumnRenamed("k", f"{name}_best_k")
        top = sweep.groupBy(SIZE).agg(F.max("silhouette").alias(f"{name}_best_silhouette"))
        out = out.join(best, SIZE, "left").join(top, SIZE, "left")
    return out
