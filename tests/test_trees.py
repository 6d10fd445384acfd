"""Nearest rows, spanning trees and condensed trees of tables larger than a tile."""

import numpy as np
import pytest

from docgroups.functions.arrays import unit_matrix
from docgroups.operators import blocks, density, forest, geometry, silhouette
from test_groups import dense_groups, distances, partition, table


def odd_rows(n, seed):
    """Rows around centres, copies, rows that are nearly copies, and zero rows."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 4))
    x = centres[rng.integers(6, size=n)] + rng.normal(size=(n, 4)) * rng.choice([0.02, 0.3], size=(n, 1))
    x[3:n // 5] = x[0]
    x[n // 2:n // 2 + 9] = np.round(x[n // 2:n // 2 + 9], 1)
    x[rng.integers(n, size=4)] = 0
    return x


def all_distances(u):
    i, j = np.indices((len(u), len(u)))
    whole = np.round(geometry.pair_distances(u, i.ravel(), j.ravel()), 12).reshape(len(u), -1)
    np.fill_diagonal(whole, np.inf)
    return whole


def light_tree(dist, core, allowed):
    """Kruskal over all pairs in the order (weight, lower, higher)."""
    n, root, tree = len(dist), list(range(len(dist))), []

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for w, i, j in sorted((max(dist[i, j], core[i], core[j]), i, j) for i in range(n) for j in range(i + 1, n) if allowed(i, j)):
        a, b = top(i), top(j)
        if a != b:
            root[a] = b
            tree.append((i, j, w))
    return sorted(tree)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("across", [False, True])
def test_cell_trees(monkeypatch, seed, across):
    for module in (geometry, density):
        monkeypatch.setattr(module, "NEAR_ROWS", 16)
        monkeypatch.setattr(module, "NEAR_COLUMNS", 32)
    x = odd_rows(120, seed)
    u, side = unit_matrix(x), np.random.default_rng(seed).random(120) < 0.4
    dist = all_distances(u)
    cores = np.stack([np.zeros(120), np.sort(dist, axis=1)[:, 2], np.sort(dist, axis=1)[:, 6]], axis=1)
    everyone = np.arange(120)
    left, right = (everyone[side], everyone[~side]) if across else (everyone, everyone)
    trees = list(density._cell_trees(u, cores, left, right, 4))
    for core, (a, b, w) in zip(cores.T, trees):
        want = light_tree(dist, core, lambda i, j: not across or side[i] != side[j])
        assert sorted(zip(a.tolist(), b.tolist(), w.tolist())) == want


def test_near_lists_are_exact(monkeypatch):
    monkeypatch.setattr(geometry, "NEAR_ROWS", 16)
    monkeypatch.setattr(geometry, "NEAR_COLUMNS", 32)
    u = unit_matrix(odd_rows(150, 7))
    rows, others = np.arange(0, 150, 2), np.arange(150)
    row, other, dist = geometry.near_lists(u, u.astype(np.float32), rows, others, 6, 12)
    whole = all_distances(u)
    for i in rows:
        mine = sorted(zip(dist[row == i], other[row == i]))
        assert [j for _, j in mine] == [j for _, j in sorted((d, j) for j, d in enumerate(whole[i]))[:6]]


def test_a_row_is_sent_to_few_cells(spark):
    """Of 615,000 rows, as many as 6 GB hold: once to each of 151 blocks before for trees, 76 for nearest rows."""
    rows = spark.range(1)
    assert blocks.block_count(rows, 615_000, density.TREE_BLOCK_ROWS) <= 20
    assert blocks.block_count(rows, 615_000, geometry.NEAR_BLOCK_ROWS) <= 20


def test_forest_of_edges_in_one_task(spark, monkeypatch):
    rng = np.random.default_rng(3)
    edges = [(r, int(a), int(b), float(w)) for r in (1, 2) for a in range(40) for b in range(a + 1, 40) for w in [rng.integers(6) / 4] if rng.random() < 0.2]
    df = spark.createDataFrame(edges, density.EDGE)
    one = sorted(map(tuple, forest.spanning_tree(df).collect()))
    monkeypatch.setattr(forest, "FOREST_EDGES", 0)
    assert one == sorted(map(tuple, forest.spanning_tree(df).collect()))


def test_condensed_in_one_task_as_in_rounds(spark):
    x = odd_rows(90, 5)
    rows = table(spark, x)
    here, rounds = (density.hdbscan_runs(rows, [3, 7], local_rows=n).orderBy("run", "id").collect() for n in (90, 0))
    assert here == rounds
    for size in (3, 7):
        assert partition([r["cluster"] for r in here if r["run"] == size]) == partition(dense_groups(distances(x), size))


def test_deep_tree_takes_few_jobs(spark):
    """Ever farther pairs of groups: each level of the tree was a round of several jobs."""
    angle = np.cumsum(np.repeat(0.001 * 1.06 ** np.arange(60), 5) * np.tile([1.0, 0.01, 0.01, 0.01, 0.01], 60))
    rows = table(spark, np.stack([np.cos(angle), np.sin(angle)], axis=1))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("deep-tree", "deep tree")
    try:
        found = density.run_hdbscan(rows, 4).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(found) == 300 and len({r["cluster"] for r in found}) > 2
    assert len(jobs.getJobIdsForGroup("deep-tree")) < 60


def test_sweep_rows_meet_groups_of_one_key(spark, monkeypatch):
    """Blocks follow the groups of a key, not those of all keys."""
    rng = np.random.default_rng(2)
    rows = [(run, i, rng.normal(size=3).tolist(), i % (2 + run)) for run in range(6) for i in range(20)]
    df = spark.createDataFrame(rows, "run int, id long, vec array<double>, cluster long")
    sent = []
    sequence = silhouette.F.sequence
    monkeypatch.setattr(silhouette.F, "sequence", lambda a, b: sent.append(b) or sequence(a, b))
    got = silhouette.many_group_silhouettes(df, ("run",), group_block=8)
    assert got.count() == 120
    assert all("lit(0)" in str(b) or str(b) == "Column<'0'>" for b in sent)


def test_sparse_products_are_not_dense_over_the_terms(monkeypatch):
    """A tile held all terms of its rows as dense columns; now a cell's most frequent ones alone, and the products are the same."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    x = (rng.random((60, 400)) < 1 / (2 + np.arange(400))) * rng.random((60, 400))
    x[7] = 0
    idx = [np.flatnonzero(r) for r in x]
    rows = pa.table({"idx": pa.array(idx, pa.list_(pa.int64())), "val": pa.array([r[i] for r, i in zip(x, idx)], pa.list_(pa.float64()))})
    held = []
    zeros = np.zeros
    monkeypatch.setattr(geometry.np, "zeros", lambda shape, *a, **k: held.append(shape) or zeros(shape, *a, **k))
    monkeypatch.setattr(geometry, "COMMON_TERMS", 20, raising=False)
    monkeypatch.setattr(geometry, "RARE_ROWS", 9, raising=False)
    table = rows.append_column("block", pa.array([0] * 25 + [1] * 35)).append_column("ci", pa.array([0] * 60)).append_column("cj", pa.array([1] * 60))
    got = np.full((60, 60), np.nan)
    for a, b, dist in geometry.cosine_tiles(table, 16, 10):
        got[np.ix_(a, b)] = dist
    u = unit_matrix(x)
    want = np.clip(1 - u @ u.T, 0, 2)
    assert np.allclose(got[:25, 25:], want[:25, 25:]) and np.allclose(got[25:, :25], want[25:, :25]) and np.isnan(got[:25, :25]).all()
    assert max(s[1] for s in held if isinstance(s, tuple) and len(s) == 2) <= 20
