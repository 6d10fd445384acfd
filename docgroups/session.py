"""Lineage cuts and size checks shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``, or a temporary one on a master without executors of its own."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="docgroups-")
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them back; a ``path`` is written over.

    Loops keep short plans, lost executors cost nothing already computed, and the next plan knows the
    true size of the table, so small ones are broadcast without a hint.
    """
    path = path or scratch_path(df.sparkSession, "cut")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> int:
    """Rough size of a table, from the text form of its rows."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long"))
    return df.agg(size).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when the table measures below the bound; above it the join shuffles.

    Pass a checkpointed or otherwise cheap table: the check reads it once.
    """
    return F.broadcast(df) if row_bytes(df) <= max_bytes else df
