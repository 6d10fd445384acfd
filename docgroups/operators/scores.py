"""Scores of a grouping against the truth: NMI, ARI, AMI, noise.

Rows carry a truth column, a cluster column and optional key columns; all runs of a sweep are scored
in one go by making the run's parameters the keys.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-12
TOTAL, TRUTH, CLUSTER = 0, 1, 2


def contingency(rows: DataFrame, truth: str = "label", cluster: str = "cluster", keys: tuple = ()) -> DataFrame:
    """Rows per pair of truth and cluster."""
    return rows.groupBy(*keys, truth, cluster).agg(F.count("*").alias("n"))


def cell_sizes(cells: DataFrame, truth: str, cluster: str, keys: tuple) -> DataFrame:
    """``(keys, kind, m)``: sizes of the cells, the classes and the clusters."""
    keys = list(keys)
    sets = [[*keys, truth, cluster], [*keys, truth], [*keys, cluster]]
    sizes = cells.groupingSets(
        [[F.col(c) for c in s] for s in sets], *[F.col(c) for c in sets[0]]
    ).agg(F.sum("n").alias("m"), F.grouping_id().alias("kind"))
    return sizes.select(*keys, "kind", F.col("m").cast("double").alias("m"))


def log_factorial(n: Column) -> Column:
    """ln n!, exact products up to 20 and Stirling's series above."""
    x = n.cast("double")
    series = (
        x * F.log(x) - x + F.log(x * (2 * math.pi)) / 2
        + 1 / (x * 12) - 1 / (F.pow(x, 3) * 360) + 1 / (F.pow(x, 5) * 1260)
    )
    small = F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))
    return F.when(n <= 20, small).otherwise(series)


def expected_information(sizes: DataFrame, keys: tuple) -> DataFrame:
    """``(keys, emi)``: mean mutual information of random groupings with the same sizes.

    Only distinct sizes are paired. Overlaps further from their mean than 40 deviations plus 300 weigh
    less than the smallest double and are not generated.
    """
    tally = sizes.groupBy(*keys, "kind", "m").agg(F.count("*").alias("times"))
    size = F.struct(F.col("m").alias("size"), "times")

    def of_kind(kind: int) -> Column:
        return F.collect_list(F.when(F.col("kind") == kind, size))

    per_run = tally.groupBy(*keys).agg(
        F.sum(F.when(F.col("kind") == TOTAL, F.col("m") * F.col("times"))).alias("n"),
        of_kind(TRUTH).alias("a"),
        of_kind(CLUSTER).alias("b"),
    )
    pairs = per_run.withColumn("a", F.explode("a")).withColumn("b", F.explode("b"))
    pairs = pairs.select(
        *keys, "n", F.col("a.size").alias("a"), F.col("b.size").alias("b"),
        (F.col("a.times") * F.col("b.times")).alias("times"),
    )
    n, a, b = F.col("n"), F.col("a"), F.col("b")
    mean = a * b / n
    reach = F.sqrt(mean * (n - a) / n * (n - b) / F.greatest(n - 1, F.lit(1.0))) * 40 + 300
    low = F.greatest(F.lit(1.0), a + b - n, F.floor(mean - reach)).cast("long")
    high = F.least(a, b, F.ceil(mean + reach)).cast("long")
    overlap = F.explode(F.sequence(low, high))
    terms = pairs.where(low <= high).repartition(*keys, "a", "b").withColumn("o", overlap)
    o = F.col("o")

    def lf(x: Column) -> Column:
        return log_factorial(F.round(x).cast("long"))

    chance = F.exp(
        lf(a) + lf(b) + lf(n - a) + lf(n - b) - lf(n) - lf(o) - lf(a - o) - lf(b - o) - lf(n - a - b + o)
    )
    part = o / n * F.log(n * o / (a * b)) * chance * F.col("times")
    return terms.groupBy(*keys).agg(F.sum(part).alias("emi"))


def score_groups(rows: DataFrame, truth: str = "label", cluster: str = "cluster", keys: tuple = ()) -> DataFrame:
    """``(keys, n, n_classes, n_clusters, nmi, ari, ami)``. Noise (-1) counts as one more cluster."""
    run = list(keys) or ["run"]
    cells = contingency(rows, truth, cluster, keys)
    if not keys:
        cells = cells.withColumn("run", F.lit(0))
    sizes = cell_sizes(cells, truth, cluster, tuple(run))
    m, kind = F.col("m"), F.col("kind")

    def total(kind_is: int, value: Column) -> Column:
        return F.sum(F.when(kind == kind_is, value).otherwise(F.lit(0.0)))

    pairs = m * (m - 1) / 2
    sums = sizes.groupBy(*run).agg(
        total(TOTAL, m).alias("n"),
        total(TRUTH, F.lit(1.0)).alias("n_classes"),
        total(CLUSTER, F.lit(1.0)).alias("n_clusters"),
        total(TOTAL, m * F.log(m)).alias("s_ab"),
        total(TRUTH, m * F.log(m)).alias("s_a"),
        total(CLUSTER, m * F.log(m)).alias("s_b"),
        total(TOTAL, pairs).alias("p_ab"),
        total(TRUTH, pairs).alias("p_a"),
        total(CLUSTER, pairs).alias("p_b"),
    )
    sums = sums.join(expected_information(sizes, tuple(run)), run)
    n, emi = F.col("n"), F.col("emi")
    h_a, h_b = F.log(n) - F.col("s_a") / n, F.log(n) - F.col("s_b") / n
    mi = F.log(n) + (F.col("s_ab") - F.col("s_a") - F.col("s_b")) / n
    one_group = (F.col("n_classes") == 1) & (F.col("n_clusters") == 1)
    mean_h = (h_a + h_b) / 2

    nmi = F.when(one_group, 1.0).when(mi <= EPS, 0.0).otherwise(mi / mean_h)
    all_pairs = F.greatest(n * (n - 1) / 2, F.lit(1.0))
    chance_pairs = F.col("p_a") * F.col("p_b") / all_pairs
    same = (F.col("p_ab") == F.col("p_a")) & (F.col("p_ab") == F.col("p_b"))
    ari = F.when(same, 1.0).otherwise(
        (F.col("p_ab") - chance_pairs) / ((F.col("p_a") + F.col("p_b")) / 2 - chance_pairs)
    )
    room = mean_h - emi
    safe = F.when(F.abs(room) < EPS, F.when(room < 0, -EPS).otherwise(EPS)).otherwise(room)
    ami = F.when(one_group, 1.0).when(F.abs(mi - emi) < EPS, F.when(F.abs(room) < EPS, 1.0).otherwise(0.0))
    ami = ami.otherwise((mi - emi) / safe)
    return sums.select(
        *keys, n.cast("long").alias("n"),
        F.col("n_classes").cast("long").alias("n_classes"),
        F.col("n_clusters").cast("long").alias("n_clusters"),
        nmi.alias("nmi"), ari.alias("ari"), ami.alias("ami"),
    )


def noise_fraction(cluster: Column) -> Column:
    return F.avg((cluster == -1).cast("double"))


def count_clusters(rows: DataFrame, cluster: str = "cluster", keys: tuple = ()) -> DataFrame:
    """``(keys, n_clusters, n_noise, n_labels)``; noise is no cluster but is a label."""
    c = F.col(cluster)
    sizes = rows.groupBy(*keys, c).agg(F.count("*").alias("n"))
    return sizes.groupBy(*keys).agg(
        F.count(F.when(c != -1, 1)).alias("n_clusters"),
        F.coalesce(F.sum(F.when(c == -1, F.col("n"))), F.lit(0)).alias("n_noise"),
        F.count("*").alias("n_labels"),
    )


def result_rows(
    rows: DataFrame, dataset: str, embedding: str, algorithm: str, keys: tuple = ("n_components", "k_method", "k")
) -> DataFrame:
    """Result-table rows, one per key; ``rows`` may carry a ``silhouette`` that is constant per key."""
    rows = rows if "silhouette" in rows.columns else rows.withColumn("silhouette", F.lit(None).cast("double"))
    extra = rows.groupBy(*keys).agg(
        F.max("silhouette").alias("silhouette"), noise_fraction(F.col("cluster")).alias("noise_fraction")
    )
    named = {c: F.col(c) if c in keys else F.lit(None) for c in ("n_components", "k_method", "k")}
    scored = score_groups(rows, keys=keys).join(extra, list(keys))
    return scored.select(
        F.lit(dataset).alias("dataset"),
        F.lit(embedding).alias("embedding"),
        F.lit(algorithm).alias("algorithm"),
        named["n_components"].cast("int").alias("n_components"),
        named["k_method"].cast("string").alias("k_method"),
        named["k"].cast("int").alias("k"),
        "nmi", "ari", "ami", "silhouette", "noise_fraction",
    )
