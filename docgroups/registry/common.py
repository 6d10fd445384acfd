"""Table access shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgroups.sources.corpus import read_table


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents", labelled=False)


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return rows.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"),
        F.col("label").cast("int").alias("label"),
    )


def r6(value: Column | str) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    return F.round(F.col(value) if isinstance(value, str) else value, 6) + F.lit(0.0)


def long_vectors(vectors: DataFrame, *keys: str) -> DataFrame:
    """``(keys, pos, value)``, one row per vector entry."""
    return vectors.select(*keys, F.posexplode("vec").alias("pos", "x")).select(*keys, "pos", r6("x").alias("value"))
