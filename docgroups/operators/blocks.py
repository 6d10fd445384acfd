"""Work on all pairs of rows, one bounded pair of blocks per task.

Rows fall into equal blocks by the hash of their unique id, so no block is hot. A cell is an
unordered pair of blocks; each row is sent to every cell of its block. A cell's result grows with its
rows, never with its pairs. The work over all cells is quadratic in the rows by definition.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

BLOCK_ROWS = 8192
TILE_ROWS = 1024
MAX_TASKS = 20_000


def block_count(rows: DataFrame, n_rows: int, block_rows: int = BLOCK_ROWS) -> int:
    """Enough blocks to bound a task and, on small tables, to occupy the cores."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    busy = math.ceil((math.sqrt(8 * cores + 1) - 1) / 2)
    wanted = max(math.ceil(n_rows / block_rows), busy)
    return max(1, min(wanted, math.ceil(n_rows / 64)))


def cells(rows: DataFrame, blocks: int, keys: tuple = ()) -> GroupedData:
    """Group ``rows`` by cell ``(keys, ci, cj)``; column ``block`` tells the two sides apart."""
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    sent = rows.withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = sent.withColumn("ci", F.least("block", "with")).withColumn("cj", F.greatest("block", "with")).drop("with")
    n_cells = blocks * (blocks + 1) // 2
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(n_cells, 2 * cores if keys else 1), MAX_TASKS)
    return sent.repartition(tasks, *keys, "ci", "cj").groupBy(*keys, "ci", "cj")
