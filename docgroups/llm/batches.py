"""How much of a table a Python task holds at once."""

from __future__ import annotations

import ctypes
import ctypes.util

import pyarrow as pa
from pyspark.sql import DataFrame

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def bounded(df: DataFrame) -> DataFrame:
    """``df`` itself; its rows now reach Python in batches of about BATCH_BYTES, however long the texts are.

    Batches are else counted in rows, so their size, in the JVM and in Python, follows the texts. A bound that
    the session already sets stays.
    """
    if df.sparkSession.conf.get(BYTES, None) is None:
        df.sparkSession.conf.set(BYTES, str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Return what this Python worker no longer uses to the system: it lives on, and else keeps the most it ever held."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(ctypes.util.find_library("c"))
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)
