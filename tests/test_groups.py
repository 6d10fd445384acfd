import numpy as np
import pytest
from pyspark.sql import functions as F

from docgroups.operators import density, linkage


def distances(x):
    length = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
    dist = np.round(np.clip(1 - u @ u.T, 0, 2), 12)
    np.fill_diagonal(dist, 0)
    return dist


def table(spark, x, run=None):
    rows = [(i, r.tolist()) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    return df if run is None else df.withColumn("run", F.lit(run))


def partition(labels):
    groups = {}
    for i, c in enumerate(labels):
        groups.setdefault(c, []).append(i)
    return sorted(groups.values())


def agglomerate(dist, pick):
    """Merge heights and the grouping at every count, merging the closest pair each time."""
    groups, heights, cuts = {i: [i] for i in range(len(dist))}, [], {}
    while len(groups) > 1:
        h, a, b = min((round(float(pick(dist[np.ix_(groups[a], groups[b])])), 12), a, b) for a in groups for b in groups if a < b)
        heights.append(h)
        groups[a] = groups[a] + groups.pop(b)
        cuts[len(groups)] = sorted(sorted(g) for g in groups.values())
    return heights, cuts


def agglomerate_fast(dist):
    """``agglomerate`` with mean distances that are updated, for more rows."""
    dist, size = dist.copy(), np.ones(len(dist))
    np.fill_diagonal(dist, np.inf)
    groups, heights, cuts = {i: [i] for i in range(len(dist))}, [], {}
    while len(groups) > 1:
        a, b = sorted(np.unravel_index(dist.argmin(), dist.shape))
        heights.append(dist[a, b])
        mean = (size[a] * dist[a] + size[b] * dist[b]) / (size[a] + size[b])
        size[a] += size[b]
        dist[a], dist[:, a] = mean, mean
        dist[b] = dist[:, b] = dist[a, a] = np.inf
        groups[a] = groups[a] + groups.pop(b)
        cuts[len(groups)] = sorted(sorted(g) for g in groups.values())
    return heights, cuts


@pytest.mark.parametrize("block_rows", [8192, 7])
def test_average_linkage(spark, block_rows):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 4))
    x[10], x[20] = x[3], x[3]
    y = x[:, :3]
    rows = table(spark, x, 0).unionByName(table(spark, y, 1))
    merges = linkage.average_merges(rows, block_rows)
    got = merges.collect()
    labels = linkage.cut_merges(rows, merges, [2, 3, 5, 9]).orderBy("id").collect()
    for run, data in ((0, x), (1, y)):
        heights, cuts = agglomerate(distances(data), np.mean)
        mine = sorted(r["height"] for r in got if r["run"] == run)
        assert mine == pytest.approx(sorted(heights), abs=1e-9)
        for g, k in enumerate([2, 3, 5, 9]):
            assert partition([r["labels"][g] for r in labels if r["run"] == run]) == cuts[k]


@pytest.mark.parametrize("settings", [{}, {"subset_groups": 100}])
def test_average_linkage_of_noise_takes_few_rounds(spark, monkeypatch, settings):
    """Rows about equally far apart join a growing group one by one; that must not take a round each."""
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(4, 32)), 75, axis=0) + rng.normal(size=(300, 32)) * 1.5
    searches, search = [], linkage._nearest_groups
    monkeypatch.setattr(linkage, "_nearest_groups", lambda *given: searches.append(1) or search(*given))
    rows = table(spark, x, 0)
    merges = linkage.average_merges(rows, **settings)
    heights, cuts = agglomerate_fast(distances(x))
    assert sorted(r["height"] for r in merges.collect()) == pytest.approx(heights, abs=1e-9)
    labels = linkage.cut_merges(rows, merges, [4, 30]).orderBy("id").collect()
    for g, k in enumerate([4, 30]):
        assert partition([r["labels"][g] for r in labels]) == cuts[k]
    assert len(searches) <= 16


@pytest.mark.parametrize("subset_groups", [11])
def test_average_linkage_in_subsets(spark, subset_groups):
    """Two runs, copies and zero rows, with subsets that hold a part of the groups."""
    x = np.random.default_rng(5).normal(size=(40, 4))
    x[10], x[20], x[7], x[30] = x[3], x[3], 0, 0
    rows = table(spark, x, 0).unionByName(table(spark, x[:, :3], 1))
    got = linkage.average_merges(rows, subset_groups=subset_groups).collect()
    for run, data in ((0, x), (1, x[:, :3])):
        whole = distances(data)
        whole[7, 30] = whole[30, 7] = 1.0
        heights, _ = agglomerate(whole, np.mean)
        assert sorted(r["height"] for r in got if r["run"] == run) == pytest.approx(sorted(heights), abs=1e-9)


def test_zero_rows_merge_last(spark):
    rng = np.random.default_rng(1)
    x = np.abs(rng.normal(size=(20, 3)))
    x[4], x[8], x[15] = 0, 0, 0
    labels = linkage.run_agglomerative(table(spark, x), 2).orderBy("id").collect()
    assert partition([r["cluster"] for r in labels])[1] == [4, 8, 15]


def test_single_linkage(spark):
    x = np.random.default_rng(2).normal(size=(40, 4))
    _, cuts = agglomerate(distances(x), np.min)
    for k in (2, 6):
        labels = linkage.run_agglomerative(table(spark, x), k, "single").orderBy("id").collect()
        assert partition([r["cluster"] for r in labels]) == cuts[k]


def test_unknown_linkage(spark):
    with pytest.raises(ValueError):
        linkage.run_agglomerative(table(spark, np.eye(3)), 2, "ward")


def dense_groups(dist, size):
    """Density groups from the full matrix: single-linkage tree, condensing, excess of mass."""
    n = len(dist)
    core = np.sort(dist, axis=0)[min(n - 1, size)]
    reach = np.round(np.maximum(np.maximum(dist, core[:, None]), core[None, :]), 12)
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    members, children, height = {i: [i] for i in range(n)}, {}, {}
    current, fresh = list(range(n)), n
    for w, i, j in sorted((reach[i, j], i, j) for i in range(n) for j in range(i + 1, n)):
        a, b = top(i), top(j)
        if a != b:
            left, right = current[a], current[b]
            children[fresh], height[fresh] = (left, right), w
            members[fresh] = members[left] + members[right]
            root[a], current[b] = b, fresh
            fresh += 1
    birth, kids, rows, exit_of = {0: 0.0}, {0: []}, [], {}
    stack = [(fresh - 1, 0)]
    while stack:
        node, c = stack.pop()
        while node is not None:
            lam = 1 / max(height[node], 1e-12)
            big = [s for s in children[node] if len(members[s]) >= size]
            for s in children[node]:
                if len(big) == 2:
                    new = len(birth)
                    birth[new], kids[new] = lam, []
                    kids[c].append(new)
                    rows.append((c, lam, len(members[s])))
                    stack.append((s, new))
                elif s not in big:
                    rows += [(c, lam, 1)] * len(members[s])
                    exit_of.update({p: c for p in members[s]})
            node = big[0] if len(big) == 1 else None
    stability = {c: sum((lam - birth[c]) * m for o, lam, m in rows if o == c) for c in birth}
    value, wins = dict(stability), set()
    for c in sorted(birth, reverse=True)[:-1]:
        below = sum(value[k] for k in kids[c])
        if below > stability[c]:
            value[c] = below
        else:
            wins.add(c)
    parent = {k: c for c in kids for k in kids[c]}
    labels = []
    for p in range(n):
        c, found = exit_of[p], -1
        while c in parent:
            found = c if c in wins else found
            c = parent[c]
        labels.append(found)
    return labels


def test_density_groups(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 3))
    x = np.concatenate([centres[rng.integers(5, size=60)] + rng.normal(size=(60, 3)) * 0.15, rng.normal(size=(8, 3))])
    x[5], x[9], x[11], x[12] = x[7], x[7], 0, 0
    x[20:27] = x[7]
    rows = density.hdbscan_runs(table(spark, x), [3, 6]).orderBy("id").collect()
    for size in (3, 6):
        mine = [r["cluster"] for r in rows if r["run"] == size]
        want = dense_groups(distances(x), size)
        assert partition(mine) == partition(want)
        assert [c == -1 for c in mine] == [c == -1 for c in want]


def test_all_noise(spark):
    x = np.random.default_rng(4).normal(size=(6, 3))
    rows = density.run_hdbscan(table(spark, x), 10).collect()
    assert {r["cluster"] for r in rows} == {-1} and len(rows) == 6


def test_tree_weight(spark):
    x = np.random.default_rng(6).normal(size=(150, 4))
    dist = distances(x)
    core = np.sort(dist, axis=0)[3]
    reach = np.maximum(np.maximum(dist, core[:, None]), core[None, :])
    done, near, total = {0}, reach[0].copy(), 0.0
    while len(done) < 150:
        at = min((i for i in range(150) if i not in done), key=lambda i: near[i])
        total += near[at]
        done.add(at)
        near = np.minimum(near, reach[at])
    rows = table(spark, x)
    tree = density.reachability_tree(rows, density.core_distances(rows, [3]), [3])
    assert tree.count() == 149
    assert tree.agg(F.sum("w")).first()[0] == pytest.approx(total, abs=1e-9)
