"""Jaccard join of word n-gram sets, exact, for connected components of similar documents.

Prefix filtering brings together sets that share one of their rarest shingles; index lists are skipped in blocks
by size and position. Sets first gather in stars around a leader that they are close to, similar enough or not. A set of
another star meets the leader alone. Everything else is derived from the leader: each set is kept as its difference to
it, the few shingles that only one of the two holds. For two sets of a star ``|A ^ B| = |Da| + |Db| - 2 |Da & Db|``, so those
that are not joined through the leader can only link if their differences share enough, and a prefix join on the differences,
from which the common text has dropped out, finds them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgroups.llm import chars
from docgroups.llm.batches import bounded, give_back
from docgroups.llm.graph import components
from docgroups.session import broadcast_if_small, cut

HEAD = 12  # smallest shingles that tell whether two sets are worth a comparison
COUNTERS = 1 << 22  # of the sketch that counts shingles
BLOCK = 1 << 14  # counters that are summed as one row
LOOSE = 3  # a star takes sets in so many times the distance at which sets of its leader's size link
BROADCAST_BYTES = 32 << 20
BATCH_ROWS = 1000
LEADER_ROWS = 128  # sets that meet one copy of their leader
LIST_CELLS = 100_000  # of a block of probes by the rows of its list
HELD_PAIRS = 100_000  # found pairs of a row and a star that a task holds at once
ENTRIES = 50_000  # of index lists that a task reads at once, and the list that they end in
CHUNK_BYTES = 500_000
SENT_ITEMS = 200_000  # shingles that a task sends on at once

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct runs of ``words`` words.

    Words are what white space in ASCII parts, A to Z lower-cased. A text of fewer words is one run; one
    without words, or null, has none. Distinct shingles have one hash with a chance near 2^-64 a pair.
    """
    spread = chars.mix(np.arange(1, 257, dtype=np.uint64))
    first = 0
    while first < len(texts):
        parts, size, end = [], 0, first
        while end < len(texts) and (end == first or size < CHUNK_BYTES):
            parts.append((texts[end] or "").encode().translate(_LOWER))
            size += len(parts[-1]) + 1
            end += 1
        raw = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        solid = ~_BLANK[raw]
        edges = np.diff(solid.astype(np.int8), prepend=0)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        hashes = chars.run_hashes(spread[raw], starts, ends)
        bounds = np.searchsorted(starts, offsets)
        power = chars.powers()
        runs = np.zeros(max(len(hashes) - words + 1, 0), dtype=np.uint64)
        for j in range(words):
            runs += hashes[j:len(hashes) - words + 1 + j] * power[j + 1] if len(runs) else runs
        runs = chars.mix(runs)
        for i in range(end - first):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a >= words:
                yield np.unique(runs[a:b - words + 1].view(np.int64))
            elif b > a:
                short = chars.run_hashes(hashes[a:b], np.array([0]), np.array([b - a]))
                yield short.view(np.int64)
            else:
                yield np.zeros(0, dtype=np.int64)
        first = end


def shared_needed(n):
    """So many shingles must two prefixes share if their sets are similar and the smaller has ``n``."""
    return 1 + n // 40


def prefix_size(n: int, num: int, den: int) -> int:
    """So many of the first shingles hold ``shared_needed(n)`` of every set that is similar enough."""
    return min(n, n - -(-num * n // den) + shared_needed(n))


def least_overlap(a, b, num: int, den: int):
    """Fewest common shingles of similar sets of the sizes ``a`` and ``b``."""
    return -(-num * (a + b) // (num + den))


def most_apart(both, num: int, den: int):
    """Most shingles that only one of two similar sets holds, if together they count ``both``."""
    return both - 2 * -(-num * both // (num + den))


def star_reach(n: int, num: int, den: int) -> int:
    """The distance to a leader of ``n`` shingles at which a set still joins its star; similar sets always do."""
    return max(LOOSE * most_apart(2 * n, num, den), (den - num) * n // num)


def guest_reach(n: int, num: int, den: int) -> int:
    """The distance to a leader of ``n`` shingles beyond which a set is similar to no member of its star."""
    largest = n + star_reach(n, num, den)
    return star_reach(n, num, den) + (den - num) * largest // num + 1


def _key(found: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def counter_of(shingles: np.ndarray) -> np.ndarray:
    """The place of each shingle in the sketch."""
    return (chars.mix(shingles.view(np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(COUNTERS)).astype(np.int64)


def shingle_counts(docs: DataFrame, words: int) -> np.ndarray:
    """In how many rows the shingles of each of COUNTERS classes are, from all shingles of all rows.

    The sketch has one size for any input, so no shingle is unknown. Any counts give the same links; these keep long lists out of the prefixes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            for at in range(0, len(batch), BATCH_ROWS):
                for u in shingle_sets(batch.slice(at, BATCH_ROWS).column("text").to_pylist(), words):
                    np.add.at(sketch, counter_of(u), np.uint32(1))
        for first in range(0, COUNTERS, BLOCK):
            part = sketch[first:first + BLOCK]
            if part.any():
                packed = pa.compress(part.tobytes(), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([pa.array([first // BLOCK], pa.int32()), pa.array([packed], pa.binary())], ["block", "counts"])
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["block", "counts"])

        block, total = None, np.zeros(BLOCK, dtype=np.int64)
        for batch in batches:
            for number, packed in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                if block is not None and number != block:
                    yield row()
                    total = np.zeros(BLOCK, dtype=np.int64)
                block = number
                total += np.frombuffer(pa.decompress(packed, decompressed_size=4 * BLOCK, codec="zstd", asbytes=True), dtype=np.uint32)
        if block is not None:
            yield row()

    parts = bounded(docs.select("text")).mapInArrow(count, "block int, counts binary")
    sums = parts.repartition("block").sortWithinPartitions("block").mapInArrow(add, "block int, counts binary")
    counts = np.zeros(COUNTERS, dtype=np.float32)
    for block, part in sums.collect():  # COUNTERS numbers, whatever the input
        counts[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(part, dtype=np.float32)
    return counts


def signatures(docs: DataFrame, words: int, num: int, den: int, counts: np.ndarray) -> DataFrame:
    """``(doc_id, n, hi, lo, rare, anchor, head, prefix)``: size and key of each row's set, the less the more common its shingles are, its minimum in another order, its smallest and its rarest shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in (whole.slice(at, BATCH_ROWS) for whole in batches for at in range(0, len(whole), BATCH_ROWS)):
            n, keys, rare, anchors, heads, prefixes = [], [], [], [], [], []
            for u in shingle_sets(batch.column("text").to_pylist(), words):
                n.append(len(u))
                if not len(u):
                    keys.append((0, 0))
                    rare.append(0.0)
                    anchors.append(0)
                    heads.append([])
                    prefixes.append([])
                    continue
                keys.append(_key(u))
                other = chars.mix(u.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
                anchors.append(int(other.min().view(np.int64)))
                heads.append(u[:HEAD])
                often = counts[counter_of(u)]
                rare.append(-float(np.log2(1 + often.astype(np.float64)).mean()))
                prefixes.append(u[np.lexsort((u, often))[:prefix_size(len(u), num, den)]])
            hi, lo = zip(*keys) if keys else ((), ())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                pa.array(rare, pa.float64()), pa.array(anchors, pa.int64()), pa.array(heads, pa.list_(pa.int64())), pa.array(prefixes, pa.list_(pa.int64())),
            ], ["doc_id", "n", "hi", "lo", "rare", "anchor", "head", "prefix"])
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs.select("doc_id", "text")).mapInArrow(sign, f"doc_id {kind}, n int, hi long, lo long, rare double, anchor long, head array<long>, prefix array<long>")


def _if_small(df: DataFrame) -> DataFrame:
    """Broadcast a written table of at most BROADCAST_BYTES as text; otherwise the join shuffles."""
    return broadcast_if_small(df, BROADCAST_BYTES)


def _verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``(a, b, apart, linked, diff)`` of distinct ``(a, b)``: shingles in one of the two sets only, whether they are similar, and those shingles if a star of ``b`` has use for them, else null.

    Sets are made anew from the text of the document that stands for each node, and move once: those of ``a`` to
    the set of ``b``, which is copied for every LEADER_ROWS of them.
    """
    salts = pairs.groupBy("b").agg(F.ceil(F.count("*") / LEADER_ROWS).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("a"), F.col("salts")).cast("int")
    members = pairs.join(salts, "b").select(F.col("a").alias("node"), F.struct("b", salt.alias("salt"), F.lit(1).alias("role")).alias("job"))
    each = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    leaders = salts.select("b", each).select(F.col("b").alias("node"), F.struct("b", "salt", F.lit(0).alias("role")).alias("job"))
    # A set with very many copies to make is made in several rows.
    share = F.when(F.col("job.role") == 0, F.floor(F.col("job.salt") / 512)).otherwise(0)
    jobs = members.unionByName(leaders).groupBy("node", share).agg(F.collect_list("job").alias("jobs")).select("node", "jobs")
    wanted = cut(jobs.join(classes.select("node", "least", "hi", "lo"), "node"))
    rows = docs.select("doc_id", "text").join(_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("least")))

    def sent(out: list[tuple]) -> pa.RecordBatch:
        b, number, role, node, items = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(b), pa.array(number, pa.int32()), pa.array(role, pa.int32()), pa.array(node), pa.array(items, pa.list_(pa.int64()))],
            ["b", "salt", "role", "a", "items"],
        )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                found = shingle_sets(part.column("text").to_pylist(), words)
                for node, hi, lo, meetings, u in zip(*(part.column(c).to_pylist() for c in ("node", "hi", "lo", "jobs")), found):
                    if not len(u) or _key(u) != (hi, lo):  # an id may have several rows
                        continue
                    for m in meetings:
                        out.append((m["b"], m["salt"], m["role"], node, u))
                        size += len(u)
                        if size >= SENT_ITEMS:
                            yield sent(out)
                            out, size = [], 0
        if out:
            yield sent(out)
        give_back()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, leader = np.zeros(0, np.int64), None
        for batch in batches:
            a, b, apart, linked, diff = [], [], [], [], []
            for group, role, node, items in zip(batch.column("b").to_pylist(), batch.column("role").to_pylist(), batch.column("a").to_pylist(), batch.column("items")):
                x = items.values.to_numpy()
                if role == 0:
                    y, leader = x, group
                    continue
                assert leader == group
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = y[at] == x
                common = int(shared.sum())
                a.append(node)
                b.append(group)
                apart.append(len(x) + len(y) - 2 * common)
                linked.append(den * common >= num * (len(x) + len(y) - common))
                if apart[-1] <= guest_reach(len(y), num, den):
                    gone = np.ones(len(y), dtype=bool)
                    gone[at[shared]] = False
                    diff.append(np.concatenate([x[~shared], y[gone]]))
                else:
                    diff.append(None)
            yield pa.RecordBatch.from_arrays([
                pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(apart, pa.int32()), pa.array(linked, pa.bool_()), pa.array(diff, pa.list_(pa.int64())),
            ], ["a", "b", "apart", "linked", "diff"])
        give_back()

    made = bounded(rows.select("node", "hi", "lo", "jobs", "text")).mapInArrow(make, "b long, salt int, role int, a long, items array<long>")
    dealt = made.repartition("b", "salt").sortWithinPartitions("b", "salt", "role")
    return dealt.mapInArrow(compare, "a long, b long, apart int, linked boolean, diff array<long>")


def _probe(token: np.ndarray, node: np.ndarray, n: np.ndarray, pos: np.ndarray, cluster: np.ndarray, weight: np.ndarray, star: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row, star of another row of an index list that may be similar, and the row's size, distinct, and in how many lists; from rows sorted by token.

    What is found is folded and handed on whenever HELD_PAIRS are held, so the lists of one call may make any number of them.

    Rows of one cluster are joined already, and rows of one star are left to their differences. Of two stars the
    smaller one's rows probe. A list is sorted by size, and a block of probes reads only the part whose sizes can do; the places of a shared shingle bound
    what two sets can still have in common.
    """
    held, count = [], 0
    cuts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
    mixed = [np.minimum.reduceat(c, cuts[:-1]) != np.maximum.reduceat(c, cuts[:-1]) for c in (cluster, star)]
    for k in np.flatnonzero(mixed[0] & mixed[1]).tolist():
        rows = np.arange(cuts[k], cuts[k + 1])
        rows = rows[np.argsort(n[rows], kind="stable")]
        rank = np.lexsort((star[rows], weight[rows]))
        order = np.empty(len(rows), dtype=np.int64)
        order[rank] = np.cumsum(np.concatenate([[0], np.diff(star[rows][rank]) != 0]))
        probes = np.flatnonzero(order < order.max())
        size, place = n[rows], pos[rows]
        step = max(1, LIST_CELLS // len(rows))
        for at in range(0, len(probes), step):
            p = probes[at:at + step]
            a = np.searchsorted(size * den, num * size[p[0]])
            b = np.searchsorted(size * num, den * size[p[-1]], side="right")
            other = np.arange(a, b)
            near = (order[p][:, None] < order[other]) & (cluster[rows][p][:, None] != cluster[rows][other])
            smaller, larger = np.minimum(size[p][:, None], size[other]), np.maximum(size[p][:, None], size[other])
            near &= den * smaller >= num * larger
            # This shingle, those after it, and those before it in both.
            rest = np.minimum((size[p] - place[p])[:, None], size[other] - place[other]) + np.minimum(place[p][:, None], place[other])
            near &= rest >= least_overlap(size[p][:, None], size[other], num, den)
            i, j = np.nonzero(near)
            if len(i):
                # A row meets a star once in a list, however many of the star's rows do.
                held.append(np.unique(np.stack([node[rows][p[i]], star[rows][other[j]], size[p[i]]]), axis=1))
                count += held[-1].shape[1]
                if count >= HELD_PAIRS:
                    yield np.unique(np.concatenate(held, axis=1), axis=1, return_counts=True)
                    held, count = [], 0
    if held:
        yield np.unique(np.concatenate(held, axis=1), axis=1, return_counts=True)


def _candidates(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct ``(a, star)`` of ``(node, n, prefix, cluster, weight, star)`` that share enough shingles of their prefixes.

    Index lists are read in the order of tokens. In how many of them a row meets some row of a star is no less than
    what it shares with any one row of it.
    """
    entries = classes.select("node", "n", "cluster", "weight", "star", F.posexplode("prefix").alias("pos", "token"))
    entries = entries.repartition("token").sortWithinPartitions("token")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "node", "n", "pos", "cluster", "weight", "star"]
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 7
        waiting: list[list[np.ndarray]] = []
        rows = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, waiting, rows
            columns = [np.concatenate([held[i], *[w[i] for w in waiting]]) for i in range(7)]
            token = columns[0]
            end = len(token) if last else int(np.searchsorted(token, token[-1]))
            held, waiting, rows = [c[end:] for c in columns], [], 0
            if end:
                for found, times in _probe(*[c[:end] for c in columns], num, den):
                    yield pa.RecordBatch.from_arrays([*map(pa.array, found), pa.array(times.astype(np.int64))], ["a", "star", "n", "times"])

        for batch in batches:
            waiting.append([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])
            rows += len(batch)
            if rows >= ENTRIES:
                yield from flush(False)
        if waiting or len(held[0]):
            yield from flush(True)
        give_back()

    met = entries.select("token", "node", "n", "pos", "cluster", "weight", "star").mapInArrow(run, "a long, star long, n long, times long")
    counted = met.groupBy("a", "star", "n").agg(F.sum("times").alias("times"))
    smaller = F.ceil(F.col("n") * num / den).cast("long")  # the least that a similar set can have
    return counted.where(F.col("times") >= 1 + F.floor(smaller / 40)).select("a", "star")


def _meet(rows: dict[str, np.ndarray], num: int, den: int, one: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one star's index list whose differences may share enough, from rows sorted by star and token; with ``one``, one partner for a row in a list.

    The rows that are not of the list's largest cluster look for others. A list is sorted by the size of the
    differences, so that a block of them reads only the part whose sizes can do. Of two rows that link, that with the
    smaller difference has a shared shingle in the first half of what it may have apart: of the others only such rows are read.
    """
    held, count = [], 0
    star, token = rows["star"], rows["token"]
    cuts = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (star[1:] != star[:-1]), [True]]))
    mixed = np.minimum.reduceat(rows["cluster"], cuts[:-1]) != np.maximum.reduceat(rows["cluster"], cuts[:-1])
    for k in np.flatnonzero(mixed).tolist():
        part = {c: v[cuts[k]:cuts[k + 1]] for c, v in rows.items()}
        order = np.lexsort((part["node"], part["d"]))
        node, n, d, pos, cluster, member = (part[c][order] for c in ("node", "n", "d", "pos", "cluster", "member"))
        names, inverse, times = np.unique(cluster, return_inverse=True, return_counts=True)
        outside = inverse != int(times.argmax())
        early = 2 * pos <= (den - num) * n // num
        for probes, others in ((np.flatnonzero(outside & early), np.arange(len(node))), (np.flatnonzero(outside & ~early), np.flatnonzero(early))):
            if not len(others):
                continue
            step = max(1, LIST_CELLS // len(others))
            for at in range(0, len(probes), step):
                p = probes[at:at + step]
                most = int(((den - num) * n[p] // num).max())
                a = np.searchsorted(d[others], d[p[0]] - most)
                b = np.searchsorted(d[others], d[p[-1]] + most, side="right")
                if a == b:
                    continue
                o = others[a:b]
                mine = [v[p][:, None] for v in (node, n, d, pos, cluster, member, outside)]
                near = (mine[4] != cluster[o]) & (mine[5] | member[o]).astype(bool)
                near &= ~outside[o] | (mine[0] > node[o]) | ~early[o] | ~early[p][:, None]
                near &= den * np.minimum(mine[1], n[o]) >= num * np.maximum(mine[1], n[o])
                apart = most_apart(mine[1] + n[o], num, den)
                near &= (2 * mine[3] <= mine[2] - d[o] + apart) & (2 * pos[o] <= d[o] - mine[2] + apart)
                rest = np.minimum(mine[2] - mine[3], d[o] - pos[o]) + np.minimum(mine[3], pos[o])
                near &= 2 * rest >= mine[2] + d[o] - apart
                if one:
                    i = np.flatnonzero(near.any(axis=1))
                    j = near[i].argmax(axis=1)
                else:
                    i, j = np.nonzero(near)
                if len(i):
                    x, y = node[p[i]], node[o[j]]
                    held.append(np.unique(np.stack([np.full(len(x), part["star"][0]), np.minimum(x, y), np.maximum(x, y)]), axis=1))
                    count += held[-1].shape[1]
                    if count >= HELD_PAIRS:
                        yield np.unique(np.concatenate(held, axis=1), axis=1)
                        held, count = [], 0
    if held:
        yield np.unique(np.concatenate(held, axis=1), axis=1)


def _derived(rows: DataFrame, clusters: DataFrame, num: int, den: int, one: bool) -> DataFrame:
    """Links ``(a, b)`` between rows ``(star, node, member, n, d, diff)`` of one star and different ``clusters``, found and checked on the differences to the leader alone.

    Of two rows at least one is a member. No pair is missed for want of a shared shingle: sets of n and m shingles are similar
    if they are at most k * (n + m) apart, k = (den - num) / (den + num). Say B is not similar to the leader C, so |Db| > k * (b + c),
    and A is similar to B without a shared shingle, so |Da| + |Db| <= k * (a + b). Then |Da| < k * (a - c), but a - c is |Da| at most.
    """
    named = rows.join(clusters, "node", "left").withColumn("cluster", F.coalesce("component", "node")).drop("component")
    mixed = named.groupBy("star").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).where("low <> high").select("star")
    taking = named.join(mixed, "star", "left_semi")
    each = taking.select("star", "node", "member", "n", "d", "cluster", F.explode("diff").alias("token"))
    counted = each.groupBy("star", "token").agg(F.count("*").alias("f"), (F.min("cluster") < F.max("cluster")).alias("mixed"))
    # Shingles are ordered by how many rows of the star have them apart from the leader.
    listed = F.sort_array(F.collect_list(F.struct("f", "token", "mixed"))).alias("items")
    ordered = each.join(counted, ["star", "token"]).groupBy("star", "node", "member", "n", "d", "cluster").agg(listed)
    placed = ordered.select("star", "node", F.col("member").cast("long").alias("member"), "n", "d", "cluster", F.posexplode("items").alias("pos", "item"))
    first = 2 * F.col("pos") <= F.col("d") + F.floor((den - num) * F.col("n") / num)
    entries = placed.where(F.col("item.mixed") & first).select("star", F.col("item.token").alias("token"), "node", "n", "d", "pos", "cluster", "member")
    names = entries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {c: np.zeros(0, np.int64) for c in names}
        waiting: list[dict[str, np.ndarray]] = []
        size = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, waiting, size
            columns = {c: np.concatenate([held[c], *[w[c] for w in waiting]]) for c in names}
            changes = np.flatnonzero((np.diff(columns["star"]) != 0) | (np.diff(columns["token"]) != 0))
            end = len(columns["star"]) if last else int(changes[-1]) + 1 if len(changes) else 0
            held, waiting, size = {c: v[end:] for c, v in columns.items()}, [], 0
            if end:
                for found in _meet({c: v[:end] for c, v in columns.items()}, num, den, one):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["star", "a", "b"])

        for batch in batches:
            waiting.append({c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names})
            size += len(batch)
            if size >= ENTRIES:
                yield from flush(False)
        if waiting or len(held["star"]):
            yield from flush(True)
        give_back()

    pairs = entries.repartition("star", "token").sortWithinPartitions("star", "token").mapInArrow(run, "star long, a long, b long").distinct()

    def side(name: str) -> DataFrame:
        return taking.select("star", F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "d", "diff")])

    both = pairs.join(side("a"), ["star", "a"]).join(side("b"), ["star", "b"])
    total = F.col("n_a") + F.col("n_b")
    least = F.ceil(total * num / (num + den)).cast("long")
    return both.where(F.col("d_a") + F.col("d_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b")) <= total - 2 * least).select("a", "b")


def _edges(clusters: DataFrame) -> DataFrame:
    """One link for each node of known ``(node, component)``, in place of all that joined them."""
    return clusters.select(F.col("node").alias("a"), F.col("component").alias("b"))


def link(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``(doc_id, text)``; other columns are ignored.

    Rows link if ``den * |A and B| >= num * |A or B|`` for their sets of distinct runs of ``words`` words; a
    component is named by the smallest id that links reach, itself included, null ids left out. A row whose set is empty links
    with nothing. Rows with equal sets, repeated rows and ids among them, are one node.
    """
    signed = cut(signatures(docs, words, num, den, shingle_counts(docs, words)))
    full = signed.where("n > 0")
    grouped = full.groupBy("hi", "lo").agg(F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("n", "rare", "anchor", "head", "prefix")])
    classes = cut(grouped.select(F.monotonically_increasing_id().alias("node"), "*"))

    # Stars: sets that share a minimum meet the one of them with the most common shingles, if their smallest shingles
    # are alike. Of copies that were changed here and there this is the least changed one, to which most are
    # similar though not to each other. What this misses is found below.
    anchored = classes.select("node", "n", "rare", "head", F.posexplode(F.array(F.col("head")[0], F.col("anchor"))).alias("which", "anchor"))
    first = F.min(F.struct("rare", "node", "n", "head")).alias("first")
    leaders = anchored.groupBy("which", "anchor").agg(first, F.count("*").alias("rows")).where("rows > 1").select("which", "anchor", "first")
    # The two leaders of one family become one: a leader that meets a better one in its other group gives its rows to it.
    leaders = cut(leaders)
    meeting = anchored.join(leaders.select(F.col("first.node").alias("node")).distinct(), "node", "left_semi").join(leaders, ["which", "anchor"])
    better = meeting.groupBy("node").agg(F.min("first").alias("best"))
    leaders = leaders.join(better, F.col("first.node") == F.col("node")).select("which", "anchor", "first", "best")

    def suits(one: str) -> Column:
        fits = F.least("n", f"{one}.n") * den >= F.greatest("n", f"{one}.n") * num
        alike = F.size(F.array_intersect("head", f"{one}.head")) * 2 >= F.least(F.size("head"), F.size(f"{one}.head"))
        return (F.col("node") != F.col(f"{one}.node")) & fits & alike

    met = anchored.join(leaders, ["which", "anchor"])
    chosen = F.when(suits("best"), F.col("best.node")).when(suits("first"), F.col("first.node"))
    pairs = cut(met.select(F.col("node").alias("a"), chosen.alias("b")).where("b IS NOT NULL").distinct())
    checked = cut(_verify(docs, classes, pairs, words, num, den))
    links = checked.where("linked").select("a", "b")

    # Every set is in one star: a leader's own, or the nearest leader's that it is close to.
    size = classes.select("node", "n")
    reach = LOOSE * (2 * F.col("n") - 2 * F.ceil(2 * F.col("n") * num / (num + den)))  # as star_reach
    close = checked.join(size.withColumnRenamed("node", "b"), "b").where(F.col("linked") | (F.col("apart") <= reach))
    leading = close.select(F.col("b").alias("node")).distinct()
    joined = close.join(leading, F.col("a") == F.col("node"), "left_anti")
    nearest = F.min(F.struct("apart", "b")).alias("s")
    stars = cut(joined.groupBy(F.col("a").alias("node")).agg(nearest).select("node", F.col("s.b").alias("star")))
    weights = stars.groupBy("star").agg(F.count("*").alias("weight"))
    clusters = components(links)
    known = classes.select("node", "n", "prefix").join(stars, "node", "left").withColumn("star", F.coalesce("star", "node"))
    known = known.join(weights, "star", "left").join(clusters, "node", "left").select(
        "node", "n", "prefix", F.coalesce("component", "node").alias("cluster"), F.coalesce("weight", F.lit(0)).alias("weight"), "star",
    )

    # A set against the leaders of stars of other clusters.
    met = cut(_candidates(known, num, den).select("a", F.col("star").alias("b")))
    against = cut(_verify(docs, classes, met, words, num, den))
    clusters = components(_edges(clusters).union(against.where("linked").select("a", "b")))

    # The members of a star, and the sets of other stars that met its leader, similar to it or not, by their differences to the leader.
    members = checked.join(stars, (F.col("a") == F.col("node")) & (F.col("b") == F.col("star"))).select("star", "node", F.lit(True).alias("member"), "apart", "diff")
    led = stars.select(F.col("star").alias("b")).distinct()
    guests = against.where("diff IS NOT NULL").join(led, "b", "left_semi").select(F.col("b").alias("star"), F.col("a").alias("node"), F.lit(False).alias("member"), "apart", "diff")
    rows = cut(members.unionByName(guests).join(size, "node").select("star", "node", "member", F.col("n").cast("long").alias("n"), F.col("apart").cast("long").alias("d"), "diff"))
    # One partner for each row and list joins most of what links; then all pairs between the clusters that are left.
    for one in (True, False):
        found = cut(_derived(rows, clusters, num, den, one))
        if not found.isEmpty():
            clusters = components(_edges(clusters).union(found))

    named = classes.select("node", "hi", "lo", "least").join(clusters, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    names = named.join(ids, "component").select("hi", "lo", "component_id")
    linked = full.select("doc_id", "n", "hi", "lo").join(names, ["hi", "lo"]).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    alone = signed.where("n = 0").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """One row of each group of similar documents, with all columns: that with the smallest id, of equal ids any one.

    A null id comes after others.
    """
    row = "_join_row"
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    groups = link(numbered.select(F.col(row).alias("doc_id"), "text"), words, num, den).where("doc_id <> component_id OR n_shingles > 0")
    groups = groups.select(F.col("doc_id").alias(row), "component_id")
    ids = numbered.select(row, F.col("doc_id").alias("_id")).join(groups, row)
    first = F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", row)).alias("first")
    keepers = ids.groupBy("component_id").agg(first).select(F.col(f"first.{row}").alias(row))
    dropped = cut(groups.select(row).join(keepers, row, "left_anti"))
    return numbered.join(_if_small(dropped), row, "left_anti").select(*docs.columns)
