"""Density-based grouping: core distances, mutual reachability, spanning tree, condensed tree.

All steps handle several runs at once: a run is one ``min_cluster_size`` (column ``run``). Distances
are cosine distances. Noise rows get cluster -1, other clusters the lowest id of their rows.

The condensed tree is built without ordering all edges in one place:

1. A row turns *live* at the first edge, in weight order, that gives its component
   ``min_cluster_size`` rows. Only components below that size are followed to find it.
2. An edge splits a cluster exactly when both its ends were live before it. All other edges just add
   rows to a cluster, so the rest of the tree falls into one region per leaf cluster.
3. Regions merge along splitting edges, all pairs whose lightest edge is the same in one round; the
   number of rounds is the depth of the condensed tree, not the number of rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgroups.functions.arrays import matrix, unit_matrix
from docgroups.operators.blocks import block_count, cells
from docgroups.operators.forest import cheapest_exits, follow, joined, relabel, spanning_tree
from docgroups.operators.geometry import NEAR_COLUMNS, NEAR_ROWS, near_lists, nearest_neighbours, pair_distances, slack
from docgroups.operators.scores import count_clusters
from docgroups.operators.silhouette import masked_silhouette
from docgroups.session import cut

TREE_BLOCK_ROWS = 32_768
LISTED = 16  # nearest rows that a row lists in a cell, beyond those of its core
LOCAL_ROWS = 1 << 19  # rows of a run whose tree is condensed in one task
EDGE = "run int, a long, b long, w double"
SMALLEST = 1e-12


def core_distances(vectors: DataFrame, sizes: list[int]) -> DataFrame:
    """``(run, id, core)``: distance to the run-th nearest other row, or to the furthest if there are fewer."""
    near = nearest_neighbours(vectors, max(sizes)).select("id", "rank", F.round("dist", 12).alias("dist"))
    wanted = F.explode(F.array(*[F.lit(s) for s in sizes])).alias("run")
    reached = near.select("id", "rank", "dist", wanted).where(F.col("rank") <= F.col("run"))
    return reached.groupBy("run", "id").agg(F.max("dist").alias("core"))


def mutual_reachability(pairs: DataFrame, cores: DataFrame) -> DataFrame:
    """Add ``reach`` to ``(id, neighbour, dist)`` pairs: the larger of both cores and the distance."""
    a = cores.select("run", "id", F.col("core").alias("core_a"))
    b = cores.select("run", F.col("id").alias("neighbour"), F.col("core").alias("core_b"))
    joined = pairs.join(a, "id").join(b, ["run", "neighbour"])
    reach = F.greatest(F.round("dist", 12), "core_a", "core_b")
    return joined.select("run", "id", "neighbour", "dist", reach.alias("reach"))


def _listed_tree(a: np.ndarray, b: np.ndarray, w: np.ndarray, bound: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the edges that are surely in the spanning forest, and the components they make.

    Edges come from the lightest on. A pair of a row that is not among them weighs at least the row's ``bound``, and at that weight its lower end is at
    least ``least``: a component's lightest edge below that of all its rows is its lightest of all.
    """
    n = len(bound)
    comp, live, kept = np.arange(n), np.arange(len(a)), []
    while live.size:
        best = np.full(n, len(a))
        for end in (comp[a[live]], comp[b[live]]):
            mine = np.full(n, len(a))
            mine[end[::-1]] = live[::-1]
            best = np.minimum(best, mine)
        order = np.lexsort((least, bound, comp))
        first = order[np.flatnonzero(np.concatenate([[True], np.diff(comp[order]) > 0]))]
        lowest = np.zeros(n, dtype=np.int64)
        lowest[comp[first]] = first
        ends = np.flatnonzero(best < len(a))
        edge, row = best[ends], lowest[ends]
        sure = (w[edge] < bound[row]) | ((w[edge] == bound[row]) & (a[edge] < least[row]))
        if not sure.any():
            break
        ends, edge = ends[sure], edge[sure]
        kept.append(np.unique(edge))
        comp = joined(comp, ends, comp[a[edge]] + comp[b[edge]] - ends)
        live = live[comp[a[live]] != comp[b[live]]]
    return np.unique(np.concatenate(kept)) if kept else live[:0], comp


class _Exits:
    """The lightest edge found so far out of each component, in the order (weight, lower place, higher place)."""

    def __init__(self, comp: np.ndarray, core: np.ndarray):
        self.comp, self.core = comp, core
        self.w, self.a, self.b = np.full(len(comp), np.inf), np.full(len(comp), -1), np.full(len(comp), -1)

    def add(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> None:
        a, b = np.minimum(a, b), np.maximum(a, b)
        ends, edge = np.concatenate([self.comp[a], self.comp[b]]), np.tile(np.arange(len(a)), 2)
        near = w[edge] <= self.w[ends]
        ends, edge = ends[near], edge[near]
        order = np.lexsort((b[edge], a[edge], w[edge], ends))
        ends, edge = ends[order], edge[order]
        first = np.flatnonzero(np.concatenate([[True], np.diff(ends) > 0])) if len(ends) else ends
        ends, edge = ends[first], edge[first]
        lower = (a[edge] < self.a[ends]) | ((a[edge] == self.a[ends]) & (b[edge] < self.b[ends]))
        better = (w[edge] < self.w[ends]) | lower
        ends, edge = ends[better], edge[better]
        self.w[ends], self.a[ends], self.b[ends] = w[edge], a[edge], b[edge]

    def dots(self, rows: np.ndarray, off: float) -> np.ndarray:
        """The product from which on a row may meet a lighter exit of its component."""
        wanted = self.w[self.comp[rows]]
        return np.where(self.core[rows] > wanted, np.inf, 1.0 - wanted - 2.0 * off).astype(np.float32)


def _scan_exits(u: np.ndarray, single: np.ndarray, exits: _Exits, left: np.ndarray, right: np.ndarray, inside: bool) -> None:
    """Find the lightest exits among all pairs of a cell; tiles inside one component are passed over."""
    comp, core, off = exits.comp, exits.core, slack(u.shape[1])

    def measure(a: np.ndarray, b: np.ndarray) -> None:
        exits.add(a, b, np.maximum(np.maximum(np.round(pair_distances(u, a, b), 12), core[a]), core[b]))

    left, right = (side[np.argsort(comp[side], kind="stable")] for side in (left, right))
    for at in range(0, len(left), NEAR_ROWS):
        rows = left[at:at + NEAR_ROWS]
        own = comp[rows]
        for start in range(at // NEAR_COLUMNS * NEAR_COLUMNS if inside else 0, len(right), NEAR_COLUMNS):
            others = right[start:start + NEAR_COLUMNS]
            theirs = comp[others]
            if own[0] == own[-1] == theirs[0] == theirs[-1]:
                continue
            dots = single[rows] @ single[others].T
            if own[-1] >= theirs[0] and theirs[-1] >= own[0]:
                dots[own[:, None] == theirs[None, :]] = -np.inf
            # A component without an exit gets one first, so that it is known what is near.
            lost = np.flatnonzero(np.isinf(exits.w[own]))
            best = dots[lost].argmax(axis=1)
            known = np.isfinite(dots[lost, best])
            measure(rows[lost[known]], others[best[known]])
            lost = np.flatnonzero(np.isinf(exits.w[theirs]))
            best = dots[:, lost].argmax(axis=0)
            known = np.isfinite(dots[best, lost])
            measure(rows[best[known]], others[lost[known]])
            r, c = np.nonzero(((dots >= exits.dots(rows, off)[:, None]) | (dots >= exits.dots(others, off)[None, :])) & np.isfinite(dots))
            if r.size:
                measure(rows[r], others[c])


def _cell_trees(u: np.ndarray, cores: np.ndarray, left: np.ndarray, right: np.ndarray, listed: int):
    """Per column of ``cores`` the spanning forest ``(a, b, w)`` of one cell, all pairs of a block or all pairs across two blocks, places in the order of ids.

    The ``listed`` nearest of every row give most of it; what they leave apart is joined by scans for each component's lightest exit.
    """
    n, inside = len(u), len(left) == len(right) and bool((left == right).all())
    single = u.astype(np.float32)
    sides = [(left, right)] if inside else [(left, right), (right, left)]
    row, other, dist = (np.concatenate(c) for c in zip(*[near_lists(u, single, r, o, listed, 12) for r, o in sides]))
    order = np.lexsort((other, dist, row))
    row, other, dist = row[order], other[order], dist[order]
    whole = np.flatnonzero(np.bincount(row, minlength=n) >= listed)
    last = np.searchsorted(row, whole, side="right") - 1
    far, after = np.full(n, np.inf), np.full(n, n)
    far[whole], after[whole] = dist[last], other[last] + 1
    lo, hi = np.minimum(row, other), np.maximum(row, other)
    once = np.unique(lo * n + hi, return_index=True)[1]
    lo, hi, dist = lo[once], hi[once], dist[once]
    for core in cores.T:
        w = np.maximum(np.maximum(dist, core[lo]), core[hi])
        order = np.lexsort((hi, lo, w))
        a, b, w = lo[order], hi[order], w[order]
        # Of unlisted pairs as heavy as the list's last, the other end comes after it; where the core weighs more, nothing is known.
        least = np.where(far >= core, np.minimum(np.arange(n), after), -1)
        kept, comp = _listed_tree(a, b, w, np.maximum(far, core), least)
        edges = [(a[kept], b[kept], w[kept])]
        while (comp != comp[0]).any():
            exits = _Exits(comp, core)
            out = comp[a] != comp[b]
            exits.add(a[out], b[out], w[out])
            if whole.size:
                _scan_exits(u, single, exits, left, right, inside)
            ends = np.flatnonzero(np.isfinite(exits.w))
            if not ends.size:
                break
            first = np.unique(exits.a[ends] * n + exits.b[ends], return_index=True)[1]
            edges.append((exits.a[ends[first]], exits.b[ends[first]], exits.w[ends[first]]))
            comp = joined(comp, ends, comp[exits.a[ends]] + comp[exits.b[ends]] - ends)
        yield tuple(np.concatenate(c) for c in zip(*edges))


def reachability_tree(
    vectors: DataFrame, cores: DataFrame | None, sizes: list[int], block_rows: int = TREE_BLOCK_ROWS, listed: int = LISTED,
) -> DataFrame:
    """``(run, a, b, w)``: minimum spanning tree of mutual reachability, per run; equal weights go by a, then b, so there is one such tree.

    Every pair of blocks gives the spanning forest of its own pairs, in which each edge left out is no
    lighter than some path; the tree of all rows lies in the union of these forests. Without cores the
    weights are plain distances.
    """
    if cores is None:
        rows = vectors.select("id", "vec", F.array(F.lit(0.0)).alias("cores"))
        sizes = [0]
    else:
        by_run = cores.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("run", "core"))).alias("cs"))
        rows = vectors.join(by_run, "id").select("id", "vec", F.col("cs.core").alias("cores"))
    sizes = sorted(sizes)

    def forest(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, block = table["id"].to_numpy(), table["block"].to_numpy()
        left, right = (np.flatnonzero(block == table[c][0].as_py()) for c in ("ci", "cj"))
        trees = _cell_trees(unit_matrix(matrix(table["vec"])), matrix(table["cores"]), left, right, listed + max(sizes))
        out = [(np.full(len(w), size, dtype=np.int32), ids[a], ids[b], w) for size, (a, b, w) in zip(sizes, trees)]
        run, a, b, w = (np.concatenate(c) for c in zip(*out))
        return pa.table({"run": run, "a": a, "b": b, "w": w})

    blocks = block_count(vectors, vectors.count(), block_rows)
    return spanning_tree(cells(cut(rows), blocks).applyInArrow(forest, EDGE))


def _order(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + c) for c in ("w", "a", "b")])


def live_levels(nodes: DataFrame, tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(run, node, level)``: the edge at which each row turns live, and ``(run, node, region)``.

    Rounds: components below ``run`` rows merge with each other when each is the other's nearest.
    One whose chain of nearest components ends in a live one turns live at its own first edge.
    """
    keys = ["run"]
    comps = nodes.select("run", F.col("node").alias("c"), F.lit(1).cast("long").alias("size"))
    comps = cut(comps.withColumn("done", F.col("size") >= F.col("run")))
    edges = cut(tree.withColumn("ca", F.col("a")).withColumn("cb", F.col("b")))
    merged, levels, hooks = [], [], []
    while not edges.isEmpty():
        small = comps.where("NOT done")
        exits = cheapest_exits(edges, keys).join(small, ["run", "c"])
        back = exits.select("run", F.col("c").alias("other"), F.col("other").alias("back"), F.col("size").alias("other_size"))
        exits = cut(exits.join(back, ["run", "other"], "left").withColumn(
            "pair", F.coalesce(F.col("back") == F.col("c"), F.lit(False))
        ))
        pairs = exits.where("pair AND c < other")
        grown = (F.col("size") + F.col("other_size")) >= F.col("run")
        pairs = pairs.select("run", "c", "other", "w", "a", "b", (F.col("size") + F.col("other_size")).alias("size"), grown.alias("done"))
        chains = exits.where("NOT pair")
        roots = follow(chains.select("run", F.col("c").alias("node"), F.col("other").alias("parent")), ("run",))
        ended = roots.join(comps.where("done").select("run", F.col("c").alias("root")), ["run", "root"], "left_semi")
        resolved = cut(chains.join(ended.select("run", F.col("node").alias("c")), ["run", "c"], "left_semi"))
        levels += [
            resolved.select("run", "c", _order().alias("level")),
            pairs.where("done").select("run", "c", _order().alias("level")),
        ]
        hooks.append(resolved.select("run", F.col("c").alias("node"), F.col("other").alias("parent")))
        moves = pairs.select("run", F.col("other").alias("node"), F.col("c").alias("root"))
        merged.append(moves.select("run", "node", F.col("root").alias("parent")))
        kept = comps.join(moves.select("run", F.col("node").alias("c")), ["run", "c"], "left_anti")
        changed = pairs.select("run", "c", F.col("size").alias("new_size"), F.col("done").alias("new_done"))
        fixed = resolved.select("run", "c", F.lit(True).alias("now"))
        kept = kept.join(changed, ["run", "c"], "left").join(fixed, ["run", "c"], "left")
        comps = cut(kept.select(
            "run", "c", F.coalesce("new_size", "size").alias("size"),
            F.coalesce("now", "new_done", "done").alias("done"),
        ))
        done = comps.where("done").select("run", "c")
        edges = relabel(edges, moves, keys)
        for end in ("ca", "cb"):
            flag = done.select("run", F.col("c").alias(end), F.lit(True).alias(f"{end}_done"))
            edges = edges.join(flag, ["run", end], "left")
        edges = cut(edges.where("ca_done IS NULL OR cb_done IS NULL").drop("ca_done", "cb_done"))
    if not levels:
        level = "struct<w:double,a:bigint,b:bigint>"
        return (nodes.select("run", "node", F.lit(None).cast(level).alias("level")),
                nodes.select("run", "node", F.col("node").alias("region")))
    joined = cut(reduce(DataFrame.unionByName, merged))
    own = nodes.join(follow(joined, ("run",)), ["run", "node"], "left").select(
        "run", "node", F.coalesce("root", "node").alias("c")
    )
    own = cut(own.join(reduce(DataFrame.unionByName, levels), ["run", "c"], "left"))
    hooked = follow(reduce(DataFrame.unionByName, hooks), ("run",)).withColumnRenamed("node", "c")
    regions = own.join(hooked, ["run", "c"], "left").select("run", "node", F.coalesce("root", "c").alias("region"))
    return own.select("run", "node", "level"), cut(regions)


def condensed_tree(tree: DataFrame, levels: DataFrame, regions: DataFrame) -> DataFrame:
    """``(run, c, parent, step, formed, born)`` of all clusters.

    ``formed`` is the edge that joined the cluster's two children (NULL for a leaf), ``born`` the edge
    at which its parent splits (NULL for the root); ``step`` is 0 for leaves and above all children.
    """
    splits = tree
    for end in ("a", "b"):
        side = levels.select("run", F.col("node").alias(end), F.col("level").alias(f"level_{end}"))
        splits = splits.join(side, ["run", end])
    splits = splits.where((F.col("level_a") < _order()) & (F.col("level_b") < _order()))
    for end in ("a", "b"):
        side = regions.select("run", F.col("node").alias(end), F.col("region").cast("string").alias(f"c{end}"))
        splits = splits.join(side, ["run", end])
    edges = cut(splits.select("run", "a", "b", "w", "ca", "cb"))
    leaf = regions.select("run", F.col("region").cast("string").alias("c")).distinct()
    order_type = "struct<w:double,a:bigint,b:bigint>"
    clusters = [leaf.select("run", "c", F.lit(0).alias("step"), F.lit(None).cast(order_type).alias("formed"))]
    links, step = [], 1
    while not edges.isEmpty():
        exits = cheapest_exits(edges, ["run"])
        pairs = exits.where("c < other").join(
            exits.select("run", F.col("c").alias("other"), F.col("a").alias("a2"), F.col("b").alias("b2")),
            ["run", "other"],
        ).where("a = a2 AND b = b2")
        made = F.concat_ws(":", F.split("c", ":")[0], F.lit(step))
        pairs = cut(pairs.select("run", "c", "other", _order().alias("formed"), made.alias("made")))
        both = pairs.select("run", F.explode(F.array("c", "other")).alias("c"), F.col("made").alias("parent"), F.col("formed").alias("born"))
        clusters.append(pairs.select("run", F.col("made").alias("c"), F.lit(step).alias("step"), "formed"))
        links.append(both)
        edges = cut(relabel(edges, both.select("run", F.col("c").alias("node"), F.col("parent").alias("root")), ["run"]))
        step += 1
    every = reduce(DataFrame.unionByName, clusters)
    if not links:
        return cut(every.select("run", "c", F.lit(None).cast("string").alias("parent"), "step", "formed", F.lit(None).cast(order_type).alias("born")))
    return cut(every.join(reduce(DataFrame.unionByName, links), ["run", "c"], "left").select("run", "c", "parent", "step", "formed", "born"))


def exit_clusters(levels: DataFrame, regions: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(run, node, w, c)``: the cluster each row drops out of, by climbing 2^j ancestors at a time."""
    hops = [clusters.where("parent IS NOT NULL").select("run", "c", F.col("parent").alias("up"), F.col("born").alias("formed"))]
    while True:
        last = hops[-1]
        on = last.select("run", F.col("c").alias("up"), F.col("up").alias("up2"), F.col("formed").alias("formed2"))
        longer = cut(last.join(on, ["run", "up"]).select("run", "c", F.col("up2").alias("up"), F.col("formed2").alias("formed")))
        if longer.isEmpty():
            break
        hops.append(longer)
    rows = levels.where("level IS NOT NULL").join(regions, ["run", "node"])
    rows = rows.select("run", "node", "level", F.col("region").cast("string").alias("c"))
    for hop in reversed(hops):
        rows = rows.join(hop, ["run", "c"], "left").select(
            "run", "node", "level", F.when(F.col("formed") < F.col("level"), F.col("up")).otherwise(F.col("c")).alias("c")
        )
    return cut(rows.select("run", "node", F.col("level.w").alias("w"), "c"))


def _density(w: Column) -> Column:
    return 1.0 / F.greatest(w, F.lit(SMALLEST))


def select_clusters(clusters: DataFrame, exits: DataFrame) -> DataFrame:
    """``(run, c, chosen)``: the selected cluster each cluster belongs to, by excess of mass.

    Leaves to root: a cluster wins when its own stability is at least the sum of its children's. The
    root never wins.
    """
    own = exits.groupBy("run", "c").agg(F.count("*").alias("n"), F.sum(_density(F.col("w"))).alias("mass"))
    birth = F.when(F.col("born").isNull(), 0.0).otherwise(_density(F.col("born.w")))
    facts = clusters.join(own, ["run", "c"], "left").select(
        "run", "c", "parent", "step", birth.alias("birth"),
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("mass", F.lit(0.0)).alias("mass"),
    )
    facts = cut(facts)
    steps = facts.agg(F.max("step")).first()[0] or 0
    finished = []
    waiting = None
    for step in range(steps + 1):
        now = facts.where(F.col("step") == step)
        if waiting is None:
            now = now.withColumn("cn", F.lit(0).cast("long")).withColumn("cmass", F.lit(0.0)).withColumn("best", F.lit(0.0))
        else:
            kids = waiting.groupBy("run", F.col("parent").alias("c")).agg(
                F.sum("size").alias("cn"), F.sum(F.col("size") * F.col("birth")).alias("cmass"), F.sum("value").alias("best")
            )
            now = now.join(kids, ["run", "c"])
        size = F.col("n") + F.col("cn")
        stability = F.col("mass") + F.col("cmass") - size * F.col("birth")
        wins = F.col("parent").isNotNull() & (stability >= F.col("best"))
        now = cut(now.select(
            "run", "c", "parent", "birth", size.alias("size"),
            F.when(wins, stability).otherwise(F.col("best")).alias("value"), wins.alias("wins"),
        ))
        finished.append(now)
        waiting = now if waiting is None else waiting.join(
            facts.where(F.col("step") == step).select("run", F.col("c").alias("parent")), ["run", "parent"], "left_anti"
        ).unionByName(now)
        if step % 8 == 7:
            waiting = cut(waiting)
    done = reduce(DataFrame.unionByName, finished)
    paths = done.select("run", "c", F.col("parent").alias("up"), F.when(F.col("wins"), F.col("c")).alias("chosen"))
    paths = cut(paths)
    while not paths.where("up IS NOT NULL").isEmpty():
        on = paths.select("run", F.col("c").alias("up"), F.col("up").alias("up2"), F.col("chosen").alias("higher"))
        paths = cut(paths.join(on, ["run", "up"], "left").select(
            "run", "c", F.col("up2").alias("up"), F.coalesce("higher", "chosen").alias("chosen")
        ))
    return paths.select("run", "c", "chosen")


def _condensed_runs(table: pa.Table) -> pa.Table:
    """``(run, id, chosen)`` of the rows that are not noise, from the spanning tree of one run: the steps of the rounds, edge by edge."""
    run, table = table["run"][0].as_py(), table.sort_by([("w", "ascending"), ("a", "ascending"), ("b", "ascending")])
    ids, at = np.unique(np.concatenate([table["a"].to_numpy(), table["b"].to_numpy()]), return_inverse=True)
    n, weights = len(ids), table["w"].to_numpy()
    root, live, members = list(range(n)), [-1] * n, [[i] for i in range(n)]
    exit_of, level = np.full(n, -1), np.zeros(n)
    up, born = [], []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def leave(rows: list, cluster: int, w: float) -> None:
        exit_of[rows], level[rows] = cluster, w

    def cluster() -> int:
        up.append(-1)
        born.append(np.inf)
        return len(up) - 1

    for a, b, w in zip(at[:len(weights)].tolist(), at[len(weights):].tolist(), weights.tolist()):
        a, b = top(a), top(b)
        if live[a] >= 0 and live[b] >= 0:
            target = cluster()
            for child in (live[a], live[b]):
                up[child], born[child] = target, w
        elif live[a] >= 0 or live[b] >= 0:
            target, small = (live[a], b) if live[a] >= 0 else (live[b], a)
            leave(members[small], target, w)
        elif len(members[a]) + len(members[b]) >= run:
            target = cluster()
            leave(members[a] + members[b], target, w)
        else:
            target = -1
        # The shorter list is taken in, so a run of many rows below its size costs no square.
        a, b = (a, b) if len(members[a]) >= len(members[b]) else (b, a)
        members[a] = members[a] + members[b] if target < 0 else []
        root[b], members[b], live[a] = a, [], target
    rows = np.flatnonzero(exit_of >= 0)
    size = np.bincount(exit_of[rows], minlength=len(up))
    mass = np.bincount(exit_of[rows], weights=1.0 / np.maximum(level[rows], SMALLEST), minlength=len(up))
    best, wins = np.zeros(len(up)), np.zeros(len(up), dtype=bool)
    for c, parent in enumerate(up):
        birth = 1.0 / max(born[c], SMALLEST)
        stability = mass[c] - size[c] * birth
        wins[c] = parent >= 0 and stability >= best[c]
        if parent >= 0:
            size[parent] += size[c]
            mass[parent] += size[c] * birth
            best[parent] += stability if wins[c] else best[c]
    chosen = np.where(wins, np.arange(len(up)), -1)
    for c in range(len(up) - 1, -1, -1):
        if up[c] >= 0 and chosen[up[c]] >= 0:
            chosen[c] = chosen[up[c]]
    picked = chosen[exit_of[rows]] if len(up) else rows
    rows, picked = rows[picked >= 0], picked[picked >= 0]
    return pa.table({"run": np.full(len(rows), run, dtype=np.int32), "id": ids[rows], "chosen": pa.array(picked.astype(str), pa.string())})


def chosen_rows(nodes: DataFrame, tree: DataFrame) -> DataFrame:
    """``(run, id, chosen)``: the selected cluster of each row that is not noise, by rounds over the trees of all runs."""
    levels, regions = live_levels(nodes, tree)
    clusters = condensed_tree(tree, levels, regions)
    exits = exit_clusters(levels, regions, clusters)
    chosen = select_clusters(clusters, exits)
    return exits.join(chosen, ["run", "c"]).where("chosen IS NOT NULL").select("run", F.col("node").alias("id"), "chosen")


def hdbscan_runs(vectors: DataFrame, sizes: list[int], min_samples: int | None = None, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """``(run, id, cluster)`` for each ``min_cluster_size``; ``min_samples`` follows it unless given.

    Trees of at most ``local_rows`` rows are condensed in a task each, as a deep tree takes a round for each of its levels.
    """
    sizes = sorted(set(sizes))
    if min(sizes) < 2:
        raise ValueError("min_cluster_size is at least 2")
    vectors = cut(vectors.select(F.col("id").cast("long").alias("id"), "vec"))
    if min_samples is None:
        cores = core_distances(vectors, sizes)
    else:
        runs = F.explode(F.array(*[F.lit(s) for s in sizes]))
        cores = core_distances(vectors, [min_samples]).withColumn("run", runs)
    tree = reachability_tree(vectors, cores, sizes)
    nodes = vectors.select(F.explode(F.array(*[F.lit(s) for s in sizes])).alias("run"), F.col("id").alias("node"))
    n, different = vectors.agg(F.count("*"), F.count_distinct("id")).first()
    if n == different and n <= local_rows:
        rows = cut(tree.groupBy("run").applyInArrow(_condensed_runs, "run int, id long, chosen string"))
    else:
        rows = cut(chosen_rows(nodes, tree))
    names = rows.groupBy("run", "chosen").agg(F.min("id").alias("cluster"))
    named = rows.join(names, ["run", "chosen"]).select("run", "id", "cluster")
    every = nodes.select("run", F.col("node").alias("id"))
    return every.join(named, ["run", "id"], "left").select("run", "id", F.coalesce("cluster", F.lit(-1)).alias("cluster"))


def run_hdbscan(vectors: DataFrame, min_cluster_size: int = 5, min_samples: int | None = None) -> DataFrame:
    """``(id, cluster)``."""
    return hdbscan_runs(vectors, [min_cluster_size], min_samples).select("id", "cluster")


def sweep_min_cluster_size(vectors: DataFrame, sizes) -> DataFrame:
    """``(min_cluster_size, n_clusters, n_noise, silhouette)``; NULL below two clusters."""
    found = cut(hdbscan_runs(vectors, list(sizes)))
    counts = count_clusters(found, keys=("run",))
    scores = masked_silhouette(found.join(vectors.select("id", "vec"), "id"), ("run",))
    return counts.join(scores, "run", "left").select(
        F.col("run").alias("min_cluster_size"), "n_clusters", "n_noise", "silhouette"
    )


def single_linkage_labels(vectors: DataFrame, k: int) -> DataFrame:
    """``(id, cluster)``: the spanning tree of the distances without its k - 1 heaviest edges."""
    vectors = vectors.select(F.col("id").cast("long").alias("id"), "vec")
    tree = reachability_tree(vectors, None, [0])
    heavy = tree.orderBy(F.desc("w"), F.desc("a"), F.desc("b")).limit(k - 1).select("run", "a", "b")
    kept = tree.join(F.broadcast(heavy), ["run", "a", "b"], "left_anti")
    edges, names = cut(kept.withColumn("ca", F.col("a")).withColumn("cb", F.col("b"))), []
    while not edges.isEmpty():
        exits = cut(cheapest_exits(edges, ["run"]))
        back = exits.select("run", F.col("c").alias("other"), F.col("other").alias("back"))
        hops = exits.join(back, ["run", "other"]).where("back <> c OR c > other")
        hops = hops.select("run", F.col("c").alias("node"), F.col("other").alias("parent"))
        names.append(cut(hops))
        edges = cut(relabel(edges, follow(hops, ("run",)), ["run"]))
    rows = vectors.select(F.lit(0).alias("run"), F.col("id").alias("node"))
    if names:
        roots = follow(reduce(DataFrame.unionByName, names), ("run",))
        rows = rows.join(roots, ["run", "node"], "left")
    else:
        rows = rows.withColumn("root", F.col("node"))
    root = F.coalesce("root", "node")
    firsts = rows.groupBy(root.alias("r")).agg(F.min("node").alias("first"))
    firsts = firsts.withColumn("cluster", F.row_number().over(Window.orderBy("first")) - 1)
    return rows.withColumn("r", root).join(F.broadcast(firsts), "r").select(F.col("node").alias("id"), "cluster")
