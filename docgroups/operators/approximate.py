"""Nearest rows by several tables of random projections; distances are exact, some neighbours may be missed.

In each table the signs of random projections spell a row's code. Rows whose codes begin alike fall into a bucket, and a bucket with too many
rows is told apart by more signs, so dense regions get longer prefixes and no bucket grows with the data; what all signs
leave together, copies mostly, is dealt into parts. Inside a bucket all pairs are measured. The work is rows x tables x bucket, not quadratic.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgroups.functions.arrays import matrix, unit_matrix
from docgroups.session import cut

BITS, STEP = 60, 2


def signatures(vectors: DataFrame, tables: int, seed: int = 42) -> DataFrame:
    """``(id, vec, table, code)``: BITS signs of random projections for each table, the same for any partitioning."""

    def project(batches):
        planes = None
        for t in batches:
            if not t.num_rows:
                continue
            x = matrix(t["vec"])
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((x.shape[1], tables * BITS))
            signs = (unit_matrix(x) @ planes > 0).reshape(len(x), tables, BITS)
            codes = signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_pydict({"id": t["id"], "vec": t["vec"], "codes": pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))})

    coded = vectors.select("id", "vec").mapInArrow(project, "id long, vec array<double>, codes array<long>")
    return coded.select("id", "vec", F.posexplode("codes").alias("table", "code"))


def buckets(codes: DataFrame, n_rows: int, bucket_rows: int) -> DataFrame:
    """``(id, table, depth, bucket)`` of ``(id, table, code)``: the shortest prefix with at most ``bucket_rows`` rows.

    Every turn counts the prefixes of the rows that are left, two signs longer than before.
    """
    depth, open_, done = max(0, int(math.log2(max(n_rows / bucket_rows, 1)))), cut(codes), []
    while True:
        keyed = open_.withColumn("bucket", F.shiftright("code", BITS - depth) if depth else F.lit(0).cast("long"))
        sizes = keyed.groupBy("table", "bucket").agg(F.count("*").alias("rows"))
        keyed = cut(keyed.join(sizes, ["table", "bucket"]))
        small = keyed.where(F.col("rows") <= bucket_rows)
        done.append(small.select("id", "table", F.lit(depth).alias("depth"), "bucket"))
        open_ = keyed.where(F.col("rows") > bucket_rows)
        if open_.isEmpty():
            break
        if depth + STEP > BITS:
            part = F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / bucket_rows))
            done.append(open_.select("id", "table", (F.lit(BITS + 1) + part).cast("int").alias("depth"), "bucket"))
            break
        open_, depth = open_.select("id", "table", "code"), depth + STEP
    return reduce(DataFrame.unionByName, done)


def approximate_neighbours(vectors: DataFrame, k: int, tables: int = 32, bucket_rows: int = 1024, seed: int = 42) -> DataFrame:
    """``(id, rank, neighbour, dist)`` like ``geometry.nearest_neighbours``: rows found, with their exact cosine distances.

    More tables and larger buckets find more of the nearest rows, and more rows need more tables. A row alone in all its buckets has no neighbour.
    """
    coded = cut(signatures(vectors, tables, seed))
    placed = buckets(coded.select("id", "table", "code"), vectors.count(), bucket_rows)
    rows = coded.select("id", "vec", "table").join(placed, ["id", "table"])

    def nearest(t: pa.Table) -> pa.Table:
        ids, u = t["id"].to_numpy(), unit_matrix(matrix(t["vec"]))
        dist = np.clip(1.0 - u @ u.T, 0.0, 2.0)
        np.fill_diagonal(dist, np.inf)
        take = min(k, len(ids) - 1)
        best = np.argpartition(dist, take - 1, axis=1)[:, :take] if take else np.zeros((len(ids), 0), dtype=int)
        row = np.repeat(np.arange(len(ids)), take)
        return pa.table({"id": ids[row], "neighbour": ids[best.ravel()], "dist": dist[row, best.ravel()]})

    found = rows.groupBy("table", "depth", "bucket").applyInArrow(nearest, "id long, neighbour long, dist double")
    once = found.groupBy("id", "neighbour").agg(F.min("dist").alias("dist"))
    by_dist = Window.partitionBy("id").orderBy("dist", "neighbour")
    ranked = once.withColumn("rank", F.row_number().over(by_dist)).where(F.col("rank") <= k)
    return ranked.select("id", "rank", "neighbour", "dist")
