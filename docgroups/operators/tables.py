"""Selections over sweep and result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: scores below this are drawn as zero.
NEAR_ZERO = 0.02


def best_rows(df: DataFrame, metric: str, by: list[str], ties: list[str]) -> DataFrame:
    """The row with the largest metric of each group, first by ``ties``; one map-side aggregate."""
    order = F.struct(-F.col(metric), *[F.col(c) for c in ties])
    best = F.min_by(F.struct(*df.columns), order).alias("best")
    ranked = df.where(F.col(metric).isNotNull() & ~F.isnan(metric))
    return ranked.groupBy(*by).agg(best).where("best IS NOT NULL").select("best.*")


def union_tagged(tables: dict, tag: str) -> DataFrame:
    """Stack sweep tables, each with its key in column ``tag``."""
    tagged = [df.withColumn(tag, F.lit(value)) for value, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def at_chosen_k(sweep: DataFrame, chosen: DataFrame, metric: str, keys: list[str]) -> DataFrame:
    """Value of ``metric`` at the chosen k: a join on the sweep's keys and k."""
    return chosen.join(sweep.select(*keys, "k", metric), [*keys, "k"])


def near_zero(df: DataFrame, metrics: tuple = ("nmi", "ari", "ami")) -> DataFrame:
    """Flag rows whose scores all lie below the drawing threshold."""
    return df.withColumn("degenerate", F.greatest(*[F.col(m) for m in metrics]) < NEAR_ZERO)
