"""Silhouettes of one grouping or of a whole sweep.

Grouped vectors are ``(id, vec, labels ARRAY<INT>)``: one label per grouping, in the order of a list
of group counts. A single grouping ``(id, vec, cluster)`` is the case of one label.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgroups.functions.arrays import lists, matrix, unit, unit_matrix, vector_sum
from docgroups.operators.blocks import TILE_ROWS
from docgroups.session import BROADCAST_BYTES, cut

SIDE_BYTES = 64 * 1024 * 1024  # of vectors, labels and sums on one side of a task of the Euclidean silhouette
COLUMN_TILE = 4096
SAME = 1e-9  # squared distances below are rounding when the ids are equal
SCORES = "id long, a array<double>, b array<double>, s array<double>"


def _scores(own: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """a, b and s from each row's summed distance to every group of one grouping."""
    rows = np.arange(own.size)
    mean = np.divide(sums, counts, out=np.full_like(sums, np.inf), where=counts > 0)
    size = counts[own]
    a = np.divide(sums[rows, own], size - 1, out=np.zeros(own.size), where=size > 1)
    mean[rows, own] = np.inf
    b = mean.min(axis=1)
    top = np.maximum(a, b)
    s = np.divide(b - a, top, out=np.zeros(own.size), where=(size > 1) & (top > 0) & np.isfinite(b))
    return a, np.where(np.isfinite(b), b, np.nan), s


def score_table(ids, labels: np.ndarray, sums: np.ndarray, sizes: list[np.ndarray]) -> dict:
    parts, start = [], 0
    for g, counts in enumerate(sizes):
        parts.append(_scores(labels[:, g], sums[:, start:start + counts.size], counts))
        start += counts.size
    a, b, s = (np.stack(column, axis=1) for column in zip(*parts))
    return {"id": ids, "a": lists(a), "b": lists(b), "s": lists(s)}


def group_sizes(grouped: DataFrame, ks: list[int]) -> list[np.ndarray]:
    """Rows per group of each grouping: sum(ks) numbers."""
    rows = grouped.select(F.posexplode("labels").alias("g", "c")).groupBy("g", "c").count().collect()
    sizes = [np.zeros(k) for k in ks]
    for r in rows:
        sizes[r["g"]][r["c"]] = r["count"]
    return sizes


def _distance_sums(x: np.ndarray, ids: np.ndarray, y: np.ndarray, others: np.ndarray, labels: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Summed distances of unit rows ``x`` to the groups of all groupings among ``y``.

    Rows of ``y`` with the same labels throughout are summed first; only those sums are dealt to the groups of each grouping.
    """
    order = np.lexsort(labels.T[::-1])
    y, others, labels = y[order], others[order], labels[order]
    sx, sy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    out = np.zeros((len(x), width))
    for at in range(0, len(y), COLUMN_TILE):
        part = slice(at, at + COLUMN_TILE)
        own = labels[part]
        first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]).any(axis=1)]))
        hot = np.zeros((len(first), width))
        hot[np.arange(len(first))[:, None], own[first] + starts] = 1.0
        by_id = np.argsort(others[part], kind="stable")
        sorted_ids = others[part][by_id]
        for row in range(0, len(x), TILE_ROWS):
            rows = slice(row, row + TILE_ROWS)
            dist = x[rows] @ y[part].T
            dist *= -2.0
            dist += sx[rows][:, None]
            dist += sy[part]
            np.maximum(dist, 0.0, out=dist)
            # A row is at distance 0 from itself, whatever rounding says.
            low, high = (np.searchsorted(sorted_ids, ids[rows], side=side) for side in ("left", "right"))
            mine = np.repeat(np.arange(len(low)), high - low)
            same = by_id[np.concatenate([np.arange(a, b) for a, b in zip(low, high) if a < b] or [np.zeros(0, dtype=int)])]
            near = dist[mine, same] < SAME
            dist[mine[near], same[near]] = 0.0
            np.sqrt(dist, out=dist)
            out[rows] += np.add.reduceat(dist, first, axis=1) @ hot
    return out


def euclidean_silhouettes(grouped: DataFrame, ks: list[int], side_bytes: int = SIDE_BYTES) -> DataFrame:
    """``(id, a, b, s)`` with Euclidean distances between unit rows, exactly.

    Blocks of rows meet parts of all rows, both as large as ``side_bytes`` allows: a row's sums over the groups of all groupings are
    shuffled once for each part, of which there are few. Quadratic in the rows; ``squared_silhouettes`` is the linear relative.
    """
    sizes = group_sizes(grouped, ks)
    width, n_rows = int(sum(ks)), int(sizes[0].sum())
    starts = np.concatenate([[0], np.cumsum(ks)[:-1]]).astype(int)
    first = grouped.select(F.size("vec")).first()
    row_bytes = 8 * ((first[0] if first else 0) + len(ks))
    cores = grouped.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-n_rows * row_bytes // side_bytes))
    blocks = max(1, -(-n_rows * (row_bytes + 8 * width) // side_bytes), min(-(-cores // parts), -(-n_rows // 64)))

    def dealt(own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)
        fresh = [F.col(c).alias(c) for c in ("id", "vec", "labels")]
        return grouped.select(*fresh, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own)).select("*", every)

    def summed(a: pa.Table, b: pa.Table) -> pa.Table:
        ids, labels = a["id"].to_numpy(), a["labels"].combine_chunks()
        if not (a.num_rows and b.num_rows):
            return pa.table({"id": ids[:0], "sums": pa.array([], pa.list_(pa.float64())), "labels": labels.slice(0, 0)})
        sums = _distance_sums(
            unit_matrix(matrix(a["vec"])), ids, unit_matrix(matrix(b["vec"])), b["id"].to_numpy(), matrix(b["labels"]), starts, width
        )
        return pa.table({"id": ids, "sums": lists(sums), "labels": labels})

    met = dealt("i", blocks, "j", parts).repartition(blocks * parts, "i", "j").groupBy("i", "j").cogroup(
        dealt("j", parts, "i", blocks).repartition(blocks * parts, "i", "j").groupBy("i", "j")
    )
    partial = met.applyInArrow(summed, "id long, sums array<double>, labels array<int>")
    total = partial.groupBy("id").agg(vector_sum(F.col("sums")).alias("sums"), F.first("labels").alias("labels"))

    def score(batches):
        for t in batches:
            if t.num_rows:
                yield pa.RecordBatch.from_pydict(
                    score_table(t["id"], matrix(t["labels"]), matrix(t["sums"]), sizes)
                )

    return total.mapInArrow(score, SCORES)


def group_sums(grouped: DataFrame, ks: list[int], normalize: bool = True) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sizes and summed unit vectors of all groups, sum(ks) rows, combined map-side."""
    vec = unit(F.col("vec")) if normalize else F.col("vec")
    rows = (
        grouped.select(vec.alias("vec"), F.posexplode("labels").alias("g", "c"))
        .groupBy("g", "c").agg(F.count("*").alias("n"), vector_sum(F.col("vec")).alias("total"))
        .collect()
    )
    d = len(rows[0]["total"]) if rows else 0
    sizes, sums = [np.zeros(k) for k in ks], [np.zeros((k, d)) for k in ks]
    for r in rows:
        sizes[r["g"]][r["c"]], sums[r["g"]][r["c"]] = r["n"], r["total"]
    return sizes, sums


def _linear_silhouettes(grouped: DataFrame, ks: list[int], squared: bool) -> DataFrame:
    width = len(grouped.select("vec").first()[0])
    if 8 * width * sum(ks) > BROADCAST_BYTES:
        raise ValueError("too many groups to send to every task; use many_group_silhouettes")
    sizes, sums = group_sums(grouped, ks)
    totals = np.concatenate(sums)
    starts = np.concatenate([[0], np.cumsum(ks)[:-1]]).astype(int)
    lengths = _squared_lengths(grouped, ks) if squared else None

    def score(batches):
        for t in batches:
            if not t.num_rows:
                continue
            x, labels = unit_matrix(matrix(t["vec"])), matrix(t["labels"])
            products = x @ totals.T
            count = np.concatenate(sizes)
            sq = (x * x).sum(axis=1, keepdims=True)
            if squared:
                dist = np.maximum(count * sq + np.concatenate(lengths) - 2.0 * products, 0.0)
            else:
                dist = count - products
                rows = np.arange(len(labels))[:, None]
                dist[rows, labels + starts] -= 1.0 - sq
            yield pa.RecordBatch.from_pydict(score_table(t["id"], labels, dist, sizes))

    return grouped.select("id", "vec", "labels").mapInArrow(score, SCORES)


def _squared_lengths(grouped: DataFrame, ks: list[int]) -> list[np.ndarray]:
    """Number of nonzero rows per group: the summed squared length of unit rows."""
    nonzero = F.exists("vec", lambda x: x != 0).cast("long")
    rows = (
        grouped.select(nonzero.alias("nz"), F.posexplode("labels").alias("g", "c"))
        .groupBy("g", "c").agg(F.sum("nz").alias("nz")).collect()
    )
    out = [np.zeros(k) for k in ks]
    for r in rows:
        out[r["g"]][r["c"]] = r["nz"]
    return out


def cosine_silhouettes(grouped: DataFrame, ks: list[int]) -> DataFrame:
    """``(id, a, b, s)`` with cosine distances: one scan, since their sum over a group is a dot product."""
    return _linear_silhouettes(grouped, ks, squared=False)


def squared_silhouettes(grouped: DataFrame, ks: list[int]) -> DataFrame:
    """``(id, a, b, s)`` with squared Euclidean distances between unit rows: one scan."""
    return _linear_silhouettes(grouped, ks, squared=True)


METHODS = {"euclidean": euclidean_silhouettes, "cosine": cosine_silhouettes, "squared": squared_silhouettes}


def mean_silhouettes(grouped: DataFrame, ks: list[int], method: str = "euclidean") -> DataFrame:
    """``(g, silhouette)`` per grouping; NULL with fewer than two groups or as many groups as rows."""
    return mean_of_scores(grouped, METHODS[method](grouped, ks))


def mean_of_scores(grouped: DataFrame, scores: DataFrame) -> DataFrame:
    """``(g, silhouette)`` from the scores of all rows ``(id, a, b, s)``."""
    used = grouped.select(F.posexplode("labels").alias("g", "c")).groupBy("g").agg(
        F.count_distinct("c").alias("groups"), F.count("*").alias("n")
    )
    scores = scores.select(F.posexplode("s").alias("g", "s"))
    means = scores.groupBy("g").agg(F.avg("s").alias("mean"))
    defined = (F.col("groups") >= 2) & (F.col("groups") < F.col("n"))
    return used.join(means, "g").select("g", F.when(defined, F.col("mean")).alias("silhouette"))


def many_group_silhouettes(rows: DataFrame, keys: tuple = (), group_block: int = 1024) -> DataFrame:
    """``(keys, id, cluster, a, b, s)`` for ``(keys, id, vec, cluster)`` with any number of groups.

    Cosine distances. Group sums are cut into blocks and every row block meets every group block in
    its own task, so neither side has to fit on one machine.
    """
    keys = list(keys)
    rows = rows.withColumn("vec", unit(F.col("vec")))
    groups = cut(rows.groupBy(*keys, "cluster").agg(F.count("*").alias("n"), vector_sum(F.col("vec")).alias("total")))
    # Blocks are those of one key: a sweep of many keys sends its rows to no more of them.
    n_rows, n_groups = (df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0 for df in (rows, groups))
    row_blocks = max(1, -(-n_rows // 65_536), min(rows.sparkSession.sparkContext.defaultParallelism, n_rows // 256))
    group_blocks = max(1, -(-n_groups // group_block))

    def spread(df, own, blocks, other, others, by):
        block = F.pmod(F.xxhash64(*by), F.lit(blocks)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return df.select("*", block).select("*", every)

    left = spread(rows.select(*keys, "id", "vec", "cluster"), "rb", row_blocks, "gb", group_blocks, ["id"])
    right = spread(groups, "gb", group_blocks, "rb", row_blocks, [*keys, "cluster"])

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("cluster", pa.int64()), ("own", pa.float64()),
                            ("size", pa.int64()), ("other", pa.float64())])
        schema = pa.schema([a.schema.field(k) for k in keys] + list(schema))
        if not (a.num_rows and b.num_rows):
            return schema.empty_table()
        x, total = matrix(a["vec"]), matrix(b["total"])
        n, mine, theirs = b["n"].to_numpy(), a["cluster"].to_numpy(), b["cluster"].to_numpy()
        outs = []
        for at in range(0, len(x), TILE_ROWS):
            part = x[at:at + TILE_ROWS]
            dist = n - part @ total.T
            own = mine[at:at + TILE_ROWS][:, None] == theirs[None, :]
            has = own.any(axis=1)
            col = own.argmax(axis=1)
            row = np.arange(len(part))
            self_part = 1.0 - (part * part).sum(axis=1)
            own_sum = np.where(has, dist[row, col] - self_part, np.nan)
            mean = dist / n
            mean[own] = np.inf
            outs.append((own_sum, np.where(has, n[col], 0), mean.min(axis=1)))
        own_sum, size, other = (np.concatenate(c) for c in zip(*outs))
        values = {k: a[k] for k in keys}
        values.update(id=a["id"], cluster=pa.array(mine.astype(np.int64)),
                      own=pa.array(own_sum, from_pandas=True), size=size.astype(np.int64), other=other)
        return pa.table(values).cast(schema)

    key_types = "".join(f"{k} {rows.schema[k].dataType.simpleString()}, " for k in keys)
    by = [*keys, "rb", "gb"]
    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(
        nearest, f"{key_types}id long, cluster long, own double, size long, other double"
    )
    best = met.groupBy(*keys, "id").agg(
        F.max("cluster").alias("cluster"), F.max("own").alias("own"), F.max("size").alias("size"),
        F.min("other").alias("b"),
    )
    a = F.when(F.col("size") > 1, F.col("own") / (F.col("size") - 1)).otherwise(0.0)
    top = F.greatest("a", "b")
    s = F.when((F.col("size") > 1) & (top > 0), (F.col("b") - F.col("a")) / top).otherwise(0.0)
    return best.withColumn("a", a).withColumn("s", s).select(*keys, "id", "cluster", "a", "b", "s")


def masked_silhouette(rows: DataFrame, keys: tuple = ()) -> DataFrame:
    """``(keys, silhouette)``: mean cosine silhouette without noise rows (-1), NULL below two groups."""
    kept = rows.where(F.col("cluster") != -1)
    scores = many_group_silhouettes(kept, keys).groupBy(*keys).agg(
        F.avg("s").alias("mean"), F.count_distinct("cluster").alias("groups")
    )
    return scores.select(*keys, F.when(F.col("groups") >= 2, F.col("mean")).alias("silhouette"))
