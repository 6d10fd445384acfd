"""The tables behind the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgroups.operators.tables import best_rows, near_zero

# Fixed value: the widest grid of panels.
PANEL_COLUMNS = 5


def metric_comparison(results: DataFrame) -> DataFrame:
    """Best row per dataset and algorithm, one output row per metric, near-zero results flagged."""
    best = best_rows(results, "nmi", ["dataset", "algorithm"], ["n_components", "k_method", "k"])
    long = near_zero(best).unpivot(
        ["dataset", "algorithm", "n_components", "k", "degenerate"], ["nmi", "ari", "ami"], "metric", "value"
    )
    return long.orderBy(F.desc("dataset"), "algorithm", "metric")


def scores_by_components(results: DataFrame) -> DataFrame:
    """NMI against size per rule that chose k, K-Means only."""
    rows = results.where("algorithm = 'kmeans'").select("dataset", "k_method", "n_components", "nmi")
    return rows.orderBy("dataset", "k_method", "n_components")


def selection_curves(sweep: DataFrame) -> DataFrame:
    return sweep.select("k", "inertia", "silhouette").orderBy("k")


def map_points(vectors: DataFrame, names: DataFrame) -> DataFrame:
    """``(id, x, y, category, facet_row, facet_col)`` from the first two components.

    One panel per category in sorted order, at most five to a row; only categories are ranked.
    """
    categories = names.select("category").distinct()
    place = F.row_number().over(Window.orderBy("category")) - 1
    columns = F.least(F.count("*").over(Window.partitionBy()), F.lit(PANEL_COLUMNS))
    panels = categories.select("category", place.alias("place"), columns.alias("columns")).select(
        "category", F.floor(F.col("place") / F.col("columns")).cast("int").alias("facet_row"),
        (F.col("place") % F.col("columns")).cast("int").alias("facet_col"),
    )
    points = vectors.select("id", F.get("vec", F.lit(0)).alias("x"), F.get("vec", F.lit(1)).alias("y"))
    return points.join(names, "id").join(panels, "category").select("id", "x", "y", "category", "facet_row", "facet_col")
