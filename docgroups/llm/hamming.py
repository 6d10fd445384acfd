"""Exact nearest binary codes by multi-index hashing.

A 64-bit code is cut into segments; each is a key of the index, whose rows hold the entries of a key as arrays. If no segment
of a code lies within radius r of the query's, the codes differ in more than ``segments * (r + 1) - 1`` bits. So a query
looks up its segments at growing radii, of the last radius only as many as its kth distance needs. A lookup
compares the codes of a bucket inside the row and hands on no more than can be in an answer.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgroups.session import broadcast_if_small, cut

BITS = 64
BUCKET = 256
CHUNK = 512  # entries in a row of the index


def sign_codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, code)``: bit i is set if the vector's entry i is above zero, for the first 64 entries.

    Null vectors, and ones shorter than 64 or with a null or non-finite entry, have no code and are left out.
    """
    head = F.slice(F.col(vector_col), 1, BITS)
    sound = F.forall(head, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col(vector_col).isNotNull() & (F.size(vector_col) >= BITS) & sound & F.col(id_col).isNotNull())
    code = F.lit(0).cast("long")
    for i in range(BITS):
        code = code.bitwiseOR(F.shiftleft((F.element_at(vector_col, i + 1) > 0).cast("long"), i))
    return rows.select(F.col(id_col).alias("id"), code.alias("code"))


def segments(n: int) -> list[tuple[int, int]]:
    """``(first bit, width)``: so many bits a segment that a lookup finds about BUCKET of ``n`` rows."""
    bits = max(4.0, math.log2(max(n, 1) / BUCKET)) if n > BUCKET else 4.0
    count = max(2, min(16, round(BITS / bits)))
    bounds = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def _segment(code: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1))


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for bits in combinations(range(width), radius)]


def _index(entries: DataFrame, parts: list[tuple[int, int]]) -> DataFrame:
    """``(seg, value, entries)`` of ``(code, ids)``: the entries of a key in rows of about CHUNK at most."""
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), _segment(F.col("code"), *p).alias("value")) for i, p in enumerate(parts)]))
    keyed = entries.select("code", "ids", keys.alias("s")).select("s.seg", "s.value", "code", "ids")
    sizes = keyed.groupBy("seg", "value").agg(F.count("*").alias("n")).where(F.col("n") > 2 * CHUNK)
    sizes = cut(sizes.select("seg", "value", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")))
    chunk = F.pmod(F.xxhash64("code"), F.coalesce("chunks", F.lit(1)))
    keyed = keyed.join(broadcast_if_small(sizes), ["seg", "value"], "left").withColumn("chunk", chunk)
    held = keyed.groupBy("seg", "value", "chunk").agg(F.collect_list(F.struct("code", "ids")).alias("entries"))
    return cut(held.select("seg", "value", "entries"))


def search(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, id, distance)``: the ``k`` nearest other rows of each row of ``queries``, ties by id.

    Both are ``(id, code)``; a row is no neighbour of the query with its id. Rows with one code are one
    entry of the index, with how many they are and their ``k + 1`` smallest ids, which is all that an answer can need. Queries
    with one code are searched once. A query is done as soon as ``k`` neighbours lie within what its radii
    cover; with fewer than ``k`` other rows it gets them all. Of rows with the same id the smallest code counts.
    """
    codes = codes.groupBy("id").agg(F.min("code").alias("code"))
    queries = queries.groupBy("id").agg(F.min("code").alias("code"))
    # Smallest ids of a code: of each part of a code's rows first, so a code with most rows is no burden.
    part = F.pmod(F.xxhash64("id"), F.lit(64)).alias("part")
    few = F.slice(F.sort_array(F.collect_list("id")), 1, k + 1)
    ranked = codes.withColumn("part", part)
    place = F.row_number().over(Window.partitionBy("code", "part").orderBy("id"))
    best = ranked.withColumn("place", place).where(F.col("place") <= k + 1)
    entries = cut(best.groupBy("code").agg(few.alias("ids")))
    total = codes.count()
    parts = segments(total)
    index = _index(entries, parts)
    waiting = cut(queries.select(F.col("code").alias("query")).distinct().withColumn("far", F.lit(None).cast("int")))
    found, done = None, []
    for radius in range(max(w for _, w in parts) + 1) if total > k else []:
        if waiting.isEmpty():
            break
        # As one string, for a plan of thousands of literals takes longer than the search.
        masks = [[f"{i}:{m}" for m in _masks(w, radius)] for i, (_, w) in enumerate(parts)]
        flips = F.split(F.lit(",".join(x for m in masks for x in m)), ",")
        # Codes in none of the first j + 1 segments' lookups are further than segments * radius + j.
        last = F.least(F.coalesce("far", F.lit(BITS)) - len(parts) * radius, F.lit(len(parts) - 1))
        upto = F.element_at(F.array(*[F.lit(sum(map(len, masks[:j + 1]))) for j in range(len(parts))]), last + 1)
        probes = waiting.select("query", "far", F.explode(F.slice(flips, F.lit(1), upto)).alias("f"))
        probes = probes.select("query", "far", F.split("f", ":").cast("array<long>").alias("f"))
        probes = probes.select("query", "far", F.col("f")[0].cast("int").alias("seg"), F.col("f")[1].alias("mask"))
        value = F.lit(0).cast("long")
        for i, part in enumerate(parts):
            value = F.when(F.col("seg") == i, _segment(F.col("query"), *part)).otherwise(value)
        probes = probes.select("query", "far", "seg", value.bitwiseXOR(F.col("mask")).alias("value"))

        def distance(e: Column) -> Column:
            return F.bit_count(F.col("query").bitwiseXOR(e["code"]))

        near = F.filter("entries", lambda e: distance(e) <= F.coalesce("far", F.lit(BITS)))
        near = F.transform(near, lambda e: F.struct(distance(e).alias("distance"), e["ids"].alias("ids"), e["code"].alias("code")))
        # Of a query's entries only the k + 1 nearest, equal ones by their smallest id, can be in an answer.
        hits = probes.join(index, ["seg", "value"]).select("query", F.explode(F.slice(F.sort_array(near), 1, k + 1)).alias("e"))
        hits = hits.select("query", "e.code", "e.distance", "e.ids")
        found = hits if found is None else found.unionByName(hits)
        # And of them only those with the best k + 1 ids.
        found = found.groupBy("query", "code").agg(F.first("distance").alias("distance"), F.first("ids").alias("ids"))
        rows = found.select("query", "code", "distance", F.explode("ids").alias("id"))
        order = Window.partitionBy("query").orderBy("distance", "id")
        rows = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
        found = cut(rows.groupBy("query", "code", "distance").agg(F.sort_array(F.collect_list("id")).alias("ids")))
        # k + 1 rows, as one of them may be the query's own.
        state = found.groupBy("query").agg(F.sum(F.size("ids")).alias("n"), F.max("distance").alias("most"))
        state = waiting.select("query").join(state, "query", "left").select("query", F.when(F.col("n") > k, F.col("most")).alias("far"))
        state = cut(state)
        ready = F.coalesce(F.col("far") <= len(parts) * (radius + 1) - 1, F.lit(False))
        done.append(found.join(state.where(ready), "query", "left_semi"))
        waiting = state.where(~ready)
        found = found.join(waiting, "query", "left_semi")
    if total <= k:
        # Fewer rows than asked for: at most k entries, all of them neighbours.
        few_rows = [F.struct(F.lit(r["code"]).alias("code"), F.array(*map(F.lit, r["ids"])).alias("ids")) for r in entries.collect()]
        if few_rows:
            pairs = queries.select(F.col("code").alias("query")).distinct().select("query", F.explode(F.array(*few_rows)).alias("e"))
            distance = F.bit_count(F.col("query").bitwiseXOR(F.col("e.code")))
            done = [pairs.select("query", "e.code", distance.alias("distance"), "e.ids")]
    if not done:
        return queries.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), "id", F.lit(1).alias("distance")).limit(0)
    answers = done[0]
    for more in done[1:]:
        answers = answers.unionByName(more)
    flat = answers.select(F.col("query").alias("code"), "distance", F.explode("ids").alias("id"))
    own = queries.select(F.col("id").alias("query_id"), "code").distinct()
    pairs = own.join(flat, "code").where("query_id <> id")
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return pairs.select("query_id", "rank", "id", "distance")
