"""Sweep and result tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SWEEP = "k INT, inertia DOUBLE, silhouette DOUBLE"
SCORED_SWEEP = SWEEP + ", nmi DOUBLE, ari DOUBLE, ami DOUBLE"
RESULTS = (
    "dataset STRING, embedding STRING, algorithm STRING, n_components INT, k_method STRING, k INT, "
    "nmi DOUBLE, ari DOUBLE, ami DOUBLE, silhouette DOUBLE, noise_fraction DOUBLE"
)


def write_table(df: DataFrame, path: str, kind: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown table kind {kind!r}")


def read_results(spark: SparkSession, path: str, schema: str = RESULTS, kind: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if kind == "csv" else reader.parquet(path)
