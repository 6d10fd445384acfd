"""Seeds of K-Means: careful seeding over the first rows in a random order that no partitioning changes.

The order is that of an MD5 of seed and id. Among its first SEED_ROWS different rows each next seed is drawn in proportion to the squared distance to
the seeds so far, as a race of exponential variables from an MD5 of seed, turn and id; of the first TRIALS in the race the one that
leaves the least distance wins. Seeds of a smaller k come first, so one draw serves a sweep.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED_ROWS = 1024  # a sample of bounded size; all rows take part in the rounds that follow
TRIALS = 4


def first_rows(reps: DataFrame, seed: int) -> list:
    """At most SEED_ROWS rows of a table with an ``id``, in the order of the MD5."""
    draw = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("id").cast("string")))
    return reps.withColumn("draw", draw).orderBy("draw", "id").limit(SEED_ROWS).collect()


def _uniform(seed: int, turn: int, ids: np.ndarray) -> np.ndarray:
    drawn = [int(hashlib.md5(f"{seed}-{turn}-{i}".encode()).hexdigest()[:13], 16) for i in ids]
    return (np.array(drawn, dtype=float) + 0.5) / float(1 << 52)


def spread(ids: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray, k: int, seed: int) -> list[int]:
    """Places of at most ``k`` seeds among unit rows, given as entries ``(row, column, value)``."""
    if not len(ids):
        return []
    column = np.unique(column, return_inverse=True)[1]
    starts = np.searchsorted(row, np.arange(len(ids) + 1))

    def distances(to: int) -> np.ndarray:
        dense = np.zeros(column.max() + 1)
        own = slice(starts[to], starts[to + 1])
        dense[column[own]] = value[own]
        dots = np.bincount(row, weights=value * dense[column], minlength=len(ids))
        return np.round(np.maximum(2.0 - 2.0 * dots, 0.0), 9)

    chosen, nearest = [0], distances(0)
    while len(chosen) < k:
        open_ = np.flatnonzero(nearest > 0)
        if not open_.size:
            break
        race = -np.log(_uniform(seed, len(chosen), ids[open_])) / nearest[open_]
        trial = open_[np.lexsort((ids[open_], race))[:TRIALS]]
        after = [np.minimum(nearest, distances(t)) for t in trial]
        best = int(np.argmin([round(float(a.sum()), 6) for a in after]))
        chosen.append(int(trial[best]))
        nearest = after[best]
    return chosen
