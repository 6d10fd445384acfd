"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c have the squared distance 2 - 2c. Rotated and split into blocks, two of them
within that distance lie within a proportional share of it in at least one block. So each block is a
range join of a few dimensions, and what any block finds is verified on the whole vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgroups.llm.graph import components
from docgroups.session import cut

BLOCK = 8  # dimensions
GRID = 2  # of them span the cells
TILE = 3000  # rows of a cell that meet in one task
SLACK = 1e-9
HOT_CELLS = 200_000


def rotation(dim: int) -> np.ndarray:
    """An orthogonal matrix that depends on the dimension alone."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def rotate(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated; each row's result doesn't depend on the rows beside it, so tasks agree on it."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    turn, out = rotation(vectors.shape[1]), np.zeros_like(unit)
    for i in range(len(turn)):
        out += unit[:, i:i + 1] * turn[i]
    return out


def blocks(dim: int) -> list[tuple[int, int]]:
    return [(i, min(i + BLOCK, dim)) for i in range(0, dim, BLOCK)]


def budgets(dim: int, cosine: float) -> np.ndarray:
    """Squared distance that each block may have, in proportion to its dimensions."""
    return np.array([(b - a) / dim * (2 - 2 * cosine) + SLACK for a, b in blocks(dim)])


def _vectors(column: pa.Array | pd.Series) -> np.ndarray:
    return np.array(column.to_pylist() if isinstance(column, pa.Array) else column.tolist(), dtype=np.float64)


def _cells(classes: DataFrame, cosine: float) -> DataFrame:
    """``(label, dim, block, x, y, home, node)``: where each vector lives, and the later neighbour cells it reaches into.

    A cell is twice as wide as a block's radius, so two vectors within it share a cell, or one reaches into the
    other's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, dims = batch.column("vec"), np.array(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                turned = rotate(_vectors(vectors.take(pa.array(at))))
                for b, ((first, last), budget) in enumerate(zip(blocks(dim), budgets(dim, cosine))):
                    width = 2 * np.sqrt(budget)
                    flat = np.zeros((len(at), GRID))
                    flat[:, :min(GRID, last - first)] = turned[:, first:min(last, first + GRID)] / width
                    cell = np.floor(flat).astype(np.int64)
                    for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1)):
                        near = np.ones(len(at), bool)
                        for axis, d in enumerate((dx, dy)):
                            inside = flat[:, axis] - cell[:, axis]
                            if d:
                                near &= (inside >= 0.5 - 1e-6) if d > 0 else (inside <= 0.5 + 1e-6)
                        rows = np.flatnonzero(near)
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays([
                            batch.column("label").take(pa.array(at[rows])), pa.array(np.full(n, dim), pa.int32()), pa.array(np.full(n, b), pa.int32()),
                            pa.array(cell[rows, 0] + dx), pa.array(cell[rows, 1] + dy), pa.array(np.full(n, dx == 0 and dy == 0)),
                            batch.column("node").take(pa.array(at[rows])),
                        ], ["label", "dim", "block", "x", "y", "home", "node"])

    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("label", "dim", "node", "vec").mapInArrow(run, f"label {kind}, dim int, block int, x long, y long, home boolean, node long")


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Indices of pairs that join what earlier pairs leave apart."""
    root, kept = list(range(n)), []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(i)
    return np.array(kept, dtype=np.int64)


def _join(part: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of a cell's rows: how many each row gets here, and edges that span what they join.

    A pair counts where the first block finds it, so none counts twice.
    """
    block, first_tile, second_tile = (int(part[c].iloc[0]) for c in ("block", "first", "second"))
    home, side = part["home"].to_numpy(), part["side"].to_numpy()
    node, copies = part["node"].to_numpy(), part["copies"].to_numpy()
    vectors = _vectors(part["vec"])
    turned = rotate(vectors)
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    limits = budgets(vectors.shape[1], cosine)
    bounds = blocks(vectors.shape[1])
    low, high = bounds[block]
    sub = turned[:, low:high]
    square = (sub * sub).sum(axis=1)
    if first_tile != second_tile:
        left, right, same = np.flatnonzero(side == 0), np.flatnonzero(side == 1), False
    else:
        left, right, same = np.arange(len(part)), np.flatnonzero(home), True
    left = left[np.argsort(sub[left, 0], kind="stable")]
    right = right[np.argsort(sub[right, 0], kind="stable")]
    reach = np.sqrt(limits[block])
    found = []
    for at in range(0, len(left), 256):
        rows = left[at:at + 256]
        a, b = np.searchsorted(sub[right, 0], [sub[rows[0], 0] - reach - 1e-6, sub[rows[-1], 0] + reach + 1e-6])
        cols = right[a:b]
        gap = square[rows][:, None] + square[cols] - 2 * sub[rows] @ sub[cols].T
        i, j = np.nonzero(gap <= limits[block] + 1e-6)
        i, j = rows[i], cols[j]
        if same:
            once = ~home[i] | (node[i] < node[j])
            i, j = i[once], j[once]
        for cut_at in range(0, len(i), 100_000):
            x, y = i[cut_at:cut_at + 100_000], j[cut_at:cut_at + 100_000]
            linked = (vectors[x] * vectors[y]).sum(axis=1) / (norm[x] * norm[y]) >= cosine
            x, y = x[linked], y[linked]
            apart = (turned[x] - turned[y]) ** 2
            within = np.stack([apart[:, s:e].sum(axis=1) <= limits[k] for k, (s, e) in enumerate(bounds)], axis=1)
            here = within.argmax(axis=1) == block
            found.append(np.stack([x[here], y[here]]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    links = np.bincount(pairs[0], copies[pairs[1]], len(part)) + np.bincount(pairs[1], copies[pairs[0]], len(part))
    kept = _spanning(pairs[0], pairs[1], len(part))
    counted = np.flatnonzero(links)
    return pd.DataFrame({
        "a": np.concatenate([node[counted], node[pairs[0][kept]]]),
        "b": pd.array(np.concatenate([np.full(len(counted), -1), node[pairs[1][kept]]]), dtype="int64"),
        "links": np.concatenate([links[counted], np.zeros(len(kept))]).astype(np.int64),
    })


def link(vectors: DataFrame, cosine: float) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for each row of ``(vec_id, embedding, label)``; other columns are ignored.

    Two rows link if their labels are equal and not null, their vectors equally long, and the cosine at
    least ``cosine``, which is above 0. A vector that is null, empty, zero, or holds a null or non-finite entry links with nothing: it
    has no links and is its own component. Equal vectors of a label are one node with a count, so copies are never paired.
    Repeated ids are rows of their own; a component is named by its smallest id, null ids left out.
    """
    vec = F.col("embedding")
    total = F.aggregate(vec, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sound = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull()) & F.coalesce((total > 0) & (total < float("inf")), F.lit(False))
    rows = vectors.select("vec_id", "label", vec.alias("vec"), (sound & F.col("label").isNotNull()).alias("sound"))
    grouped = rows.where("sound").groupBy("label", "vec").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = cut(grouped.select(F.monotonically_increasing_id().alias("node"), F.size("vec").alias("dim"), "*"))

    cells = cut(_cells(classes, cosine))
    place = ["label", "dim", "block", "x", "y"]
    hot = cells.groupBy(*place).agg(F.count("*").alias("n")).where(F.col("n") > TILE)
    hot = cut(hot.select(*place, F.ceil(F.col("n") / TILE).cast("int").alias("tiles")))
    if hot.count() <= HOT_CELLS:
        hot = F.broadcast(hot)
    cells = cells.join(hot, place, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    # A cell's rows are dealt over tiles; every two tiles of homes meet once, and those reaching in meet each tile.
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    cells = cells.select("*", own.alias("own"), other.alias("other"))
    cells = cells.select(
        *place, "home", "node",
        F.when(F.col("home"), F.least("own", "other")).otherwise(F.col("other")).alias("first"),
        F.when(F.col("home"), F.greatest("own", "other")).otherwise(F.col("other")).alias("second"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    full = cells.join(classes.select("node", "vec", "copies"), "node")

    def join(part: pd.DataFrame) -> pd.DataFrame:
        return _join(part, cosine)

    found = cut(full.groupBy(*place, "first", "second").applyInPandas(join, "a long, b long, links long"))
    links = found.where("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b >= 0").select("a", "b"))
    named = classes.select("node", "label", "vec", "least", "copies").join(joined, "node", "left").join(links, "node", "left")
    named = cut(named.withColumn("component", F.coalesce("component", "node")))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component").select("label", "vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.where("sound").join(named, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
