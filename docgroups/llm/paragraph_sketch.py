"""Fingerprints of documents as invertible Bloom lookup tables of their paragraphs, with DataFrame functions alone.

A text is cut into paragraphs: at line breaks, and inside a line at the first end of a sentence after 32 characters, or after 128. Their
60-bit digests are a set. A sketch has three tables of cells; each digest falls into one cell of each, and a cell holds
how many digests it has, their exclusive or and that of their checks. The sketch of SIZE cells a table is the fingerprint.

Two versions are compared by subtraction: what they share cancels out. A cell that is left with a single digest, told by its count, its check
and its place, names a paragraph of one version only; taking it out of its other cells uncovers more (peeling). When every
cell ends empty the difference is known exactly. A pair that does not get there tries again with sketches four times as
large, until it does. The likeness of two versions is the share of their paragraphs that both have.

The cells of a pair stay in one task: texts are shuffled once by document, digests are written in buckets by
document, and all rounds of peeling over a bucketed read need no exchange. The tables of a retry hold the pending pairs only.

Odd rows: a null text is an empty one, without paragraphs; two such texts have likeness 1, one of them against another text 0. Documents are ordered
by ``doc_id``, null first, then by a hash of the text; rows with both alike count as one document, each of them gets its row of the
result. A document that is alone follows itself. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgroups.session import cut, scratch_path

# How a text is cut, and the constants of a digest's check.
PARAGRAPH = r"[^\n]{0,32}[^.!?\n]{0,96}[.!?\n]*"
PRIME, FACTORS = 2147483647, (524287, 131071, 8191, 127, 31)
FIELD = (1 << 20) - 1
TABLES = 3
SIZE = 16  # cells of a table of the fingerprint
GROWTH = 4  # how much larger the sketches of a retry are
CYCLES = 4  # rounds of peeling through all tables before a pair is tried with larger sketches
KEY = ["id0", "hash"]


def paragraph_digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs: the first 60 bits of their MD5."""
    parts = F.filter(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.conv(F.substring(F.md5(p), 1, 15), 16, 10).cast("long")))


def _field(key: Column, table: int) -> Column:
    return F.shiftright(key, 20 * table).bitwiseAND(F.lit(FIELD))


def check(key: Column) -> Column:
    """31 bits that tell a single digest from the exclusive or of several: quadratic in its fields, so not linear in bits."""
    a, b, c = (_field(key, t) for t in range(TABLES))
    terms = zip((a * a, b * b, c * c, a * b, b * c), FACTORS)
    return reduce(lambda x, y: x + y, [(square % F.lit(PRIME)) * F.lit(factor) for square, factor in terms]) % F.lit(PRIME)


def cell(key: Column, table: int, size: int) -> Column:
    """The cell of a digest in a table; the check's bits count once a table has more than 2**20 cells."""
    wide = _field(key, table) + (check(key) * F.lit(FIELD + 1) if size > FIELD + 1 else F.lit(0))
    return wide % F.lit(size) + F.lit(table * size)


def _combined(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))


def sketch(elements: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``(keys, cell, n, k, c)``: the cells in use of the sketch of each key, from ``(keys, n, k)``: digests ``k`` that count ``n`` times, 1 or -1."""
    checked = elements.withColumn("c", check(F.col("k")))
    cells = F.array(*[cell(F.col("k"), t, size) for t in range(TABLES)])
    return _combined(checked.withColumn("cell", F.explode(cells)), [*keys, "cell"])


def peel(cells: DataFrame, keys: list[str], size: int, cycles: int = CYCLES, digests: bool = False) -> DataFrame:
    """Takes single digests out of their cells, table by table, ``cycles`` times.

    Rows are the cells that are not empty yet, and those with ``cell`` -1 or -2 for what was recovered of the first and of the second
    version: their number in ``n``, or with ``digests`` a row for each with the digest in ``found``. Within a table a digest has one cell, so none
    is taken out twice.
    """
    cells = cells.withColumn("found", F.lit(0).cast("long"))
    n, k, c = F.col("n"), F.col("k"), F.col("c")

    def row(cell_: Column, found: Column, n_: Column, k_: Column, c_: Column) -> Column:
        return F.struct(cell_.cast("long").alias("cell"), found.cast("long").alias("found"), n_.cast("long").alias("n"), k_.alias("k"), c_.alias("c"))

    nothing = F.lit(0).cast("long")
    for _ in range(cycles):
        for table in range(TABLES):
            single = F.col("cell").between(table * size, (table + 1) * size - 1) & (F.abs(n) == 1) & (cell(k, table, size) == F.col("cell")) & (check(k) == c)
            side = F.when(n > 0, F.lit(-1)).otherwise(F.lit(-2))
            named = row(side, k if digests else nothing, F.lit(1), nothing, nothing)
            others = [row(cell(k, t, size), nothing, -n, k, c) for t in range(TABLES) if t != table]
            empty = (F.col("cell") >= 0) & (n == 0) & (k == 0) & (c == 0)
            same = F.array(row(F.col("cell"), F.col("found"), n, k, c))
            after = F.when(single, F.array(named, *others)).when(~empty, same)
            rows = cells.select(*keys, F.explode(after).alias("r")).select(*keys, "r.*")
            cells = _combined(rows, [*keys, "cell", "found"])
    return cells.where((F.col("cell") < 0) | (n != 0) | (k != 0) | (c != 0))


def _signed(first: Column, second: Column, pair: int) -> Column:
    def side(keys: Column, sign: int) -> Column:
        return F.transform(keys, lambda k: F.struct(F.lit(pair).alias("pair"), F.lit(sign).alias("n"), k.alias("k")))

    return F.concat(side(first, 1), side(second, -1))


def differences(versions: DataFrame, keys: list[str], pairs: list[tuple[str, str]], size: int = SIZE, cycles: int = CYCLES) -> DataFrame:
    """``(keys, pair, differing)``: how many digests only one of two versions has, for pairs of array columns of ``versions``.

    ``versions`` has unique keys and should be bucketed or partitioned by them: then only the first read moves rows. Each turn
    writes its pairs; those that were not peeled whole go on with sketches GROWTH times as large.
    """
    done, pending = [], None
    while True:
        rows = versions.select(*keys, F.explode(F.concat(*[_signed(F.col(a), F.col(b), p) for p, (a, b) in enumerate(pairs)])).alias("e")).select(*keys, "e.*")
        if pending is not None:
            wanted = pending.groupBy(*keys).agg(F.collect_set("pair").alias("wanted"))
            rows = versions.join(wanted, keys).select(*keys, F.explode(F.concat(*[
                F.when(F.array_contains("wanted", p), _signed(F.col(a), F.col(b), p)).otherwise(F.array().cast("array<struct<pair:int,n:int,k:bigint>>"))
                for p, (a, b) in enumerate(pairs)
            ])).alias("e")).select(*keys, "e.*")
        left = peel(sketch(rows, [*keys, "pair"], size), [*keys, "pair"], size, cycles)
        state = cut(left.groupBy(*keys, "pair").agg(
            F.sum(F.when(F.col("cell") < 0, F.col("n")).otherwise(0)).alias("differing"), F.count_if(F.col("cell") >= 0).alias("left")
        ))
        done.append(state.where("left = 0").select(*keys, "pair", "differing"))
        pending = state.where("left > 0").select(*keys, "pair")
        if pending.isEmpty():
            return reduce(DataFrame.unionByName, done)
        size *= GROWTH


def fingerprints(versions: DataFrame, keys: list[str], columns: list[str], size: int = SIZE) -> DataFrame:
    """``(keys, columns)``: the sketch of each array of digests as text, cells in use as ``cell.count.digests.checks`` in hexadecimal, by cell.

    Rows without any digest are left out, as their sketches are empty.
    """
    def one(name: str, at: int) -> Column:
        return F.transform(name, lambda k: F.struct(F.lit(at).alias("at"), F.lit(1).alias("n"), k.alias("k")))

    every = F.concat(*[one(name, at) for at, name in enumerate(columns)])
    cells = sketch(versions.select(*keys, F.explode(every).alias("e")).select(*keys, "e.*"), [*keys, "at"], size)
    listed = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "cell", "n", "k", "c"))).alias("cells"))

    def text(at: int) -> Column:
        own = F.filter("cells", lambda x: x["at"] == at)
        return F.array_join(F.transform(own, lambda x: F.concat_ws(".", F.hex(x["cell"]), F.hex(x["n"]), F.hex(x["k"]), F.hex(x["c"]))), " ")

    return listed.select(*keys, *[text(at).alias(name) for at, name in enumerate(columns)])


def _keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, id0, hash)``: the last two name a document, null ids too, and are never null."""
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), text.alias("text"), F.coalesce(doc_id, F.lit(0)).alias("id0"), F.xxhash64(text, doc_id.isNull()).alias("hash"),
    )


def neighbours(keyed: DataFrame) -> DataFrame:
    """``(id0, hash, before_id0, before_hash, quarter)``: the document before each in the order of ids, the last before the first, and a quarter of its length.

    Ids are sorted in ranges; only the last row of each range, one a task, is looked at together.
    """
    slim = keyed.select("doc_id", *KEY, F.length("text").alias("n")).distinct()
    parts = cut(slim.repartitionByRange("doc_id", "hash").withColumn("part", F.spark_partition_id()))
    entry = F.struct("doc_id", "hash", "id0", "n")
    last = parts.groupBy("part").agg(F.max(entry).alias("last"))
    by_part = Window.orderBy("part")
    before = F.coalesce(F.lag("last").over(by_part), F.last("last").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    last = last.select("part", before.alias("before_part"))
    inside = F.lag(entry).over(Window.partitionBy("part").orderBy("doc_id", "hash"))
    linked = parts.withColumn("before", inside).join(F.broadcast(last), "part")
    linked = linked.withColumn("before", F.coalesce("before", "before_part"))
    return linked.select(*KEY, F.col("before.id0").alias("before_id0"), F.col("before.hash").alias("before_hash"), F.floor(F.col("before.n") / 4).cast("int").alias("quarter"))


def _in_buckets(df: DataFrame) -> DataFrame:
    """Written in buckets by KEY and read back: what groups by the key, and more, needs no exchange."""
    spark, name = df.sparkSession, f"paragraphs_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, *KEY).option("path", scratch_path(spark, "buckets")).saveAsTable(name)
    return spark.table(name)


def edited_versions(docs: DataFrame) -> DataFrame:
    """``(doc_id, id0, hash, copy, n_chars, edited_sha256, own, edited, next)`` for each row: the digests of its text, of its edited text and of the next document's.

    The edited text has the start of the next document in place of its last quarter, of as many code points or all.
    """
    keyed = _keyed(docs)
    rows = keyed.join(neighbours(keyed), KEY)
    # Both sides of the join below read the same columns, so texts are shuffled once.
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy(*KEY).orderBy("doc_id")))
    sent = rows.where("copy = 1").select(
        F.col("before_id0").alias("id0"), F.col("before_hash").alias("hash"), F.substring("text", F.lit(1), F.col("quarter")).alias("start"),
        paragraph_digests(F.col("text")).alias("next"),
    )
    met = rows.select("doc_id", *KEY, "copy", "text", F.length("text").alias("n")).join(sent, KEY)
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n") - F.floor(F.col("n") / 4)).cast("int")), F.col("start"))
    met = met.withColumn("changed", edited)
    return met.select(
        "doc_id", *KEY, "copy", F.col("n").cast("long").alias("n_chars"), F.sha2("changed", 256).alias("edited_sha256"),
        paragraph_digests(F.col("text")).alias("own"), paragraph_digests(F.col("changed")).alias("edited"), "next",
    )


def _likeness(a: Column, b: Column, differing: Column) -> Column:
    both, apart = F.size(a) + F.size(b), F.coalesce(differing, F.lit(0))
    return F.when(both == 0, F.lit(1.0)).otherwise((both - apart).cast("double") / (both + apart).cast("double"))


def compare(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for each row of ``docs`` (doc_id, text)."""
    versions = _in_buckets(edited_versions(docs))
    firsts = versions.where("copy = 1")
    found = differences(firsts, KEY, [("own", "edited"), ("own", "next")])
    apart = found.groupBy(*KEY).agg(F.max(F.when(F.col("pair") == 0, F.col("differing"))).alias("d0"), F.max(F.when(F.col("pair") == 1, F.col("differing"))).alias("d1"))
    prints = fingerprints(firsts, KEY, ["own", "edited"]).withColumnsRenamed({"own": "fingerprint", "edited": "edited_fingerprint"})
    rows = versions.join(apart, KEY, "left").join(prints, KEY, "left")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", F.coalesce("fingerprint", F.lit("")).alias("fingerprint"), F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        _likeness(F.col("own"), F.col("edited"), F.col("d0")).alias("near_edited"), _likeness(F.col("own"), F.col("next"), F.col("d1")).alias("near_next"),
    )
