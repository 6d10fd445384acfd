"""Secrets in texts, with DataFrame functions alone.

Patterns give base spans. Long mixed tokens are candidates too: how many owners hold a value tells an
example that everyone copies from a credential of one owner, and only the latter become spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgroups.session import cut

# Kinds in the order of their names in a digest, pattern, group of the value, least length of the value.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
BASE = [("assign", ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]
# A run of 12 value characters must follow for an assignment to count, and so on: a cheap test of whole texts.
SIEVE = {"assign": ASSIGN.removesuffix("+)") + "{12})", "access": "AKIA[A-Z0-9]{14}", "hex": "[0-9a-f]{16}"}
# Shorter runs never count and are no part of a longer one, so they need not be found.
QUICK = {"hex": "[0-9a-f]{16,}", "access": "AKIA[A-Z0-9]{14,}"}
OWNED = ("owned", "[A-Za-z0-9+/_=-]{20,}", 0, 20)
EXAMPLE_OWNERS = 3
KINDS = [k for k, *_ in BASE] + [OWNED[0]]
SPAN = "struct<start:int,end:int,kind:int,hash:string>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _starts(sizes: Column) -> Column:
    """Sum of the entries before each entry, in blocks of 128, so a text with very many stays near linear."""
    block = 128

    def running(x: Column) -> Column:
        heads = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / block).cast("int"))
        sums = F.transform(heads, lambda b: F.aggregate(F.slice(x, b * block + 1, F.lit(block)), F.lit(0), lambda s, v: s + v))
        before = F.transform(heads, lambda b: F.struct(b.alias("b"), F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), lambda s, v: s + v).alias("s")))
        return _let(before, lambda known: F.transform(x, lambda _, i: (
            F.get(known, F.floor(i / block).cast("int"))["s"]
            + F.aggregate(F.slice(x, F.floor(i / block).cast("int") * block + 1, i % block), F.lit(0), lambda s, v: s + v)
        )))

    return F.when(F.size(sizes) == 0, F.array().cast("array<int>")).otherwise(_let(sizes, running))


def _found(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Spans of a pattern in a text, leftmost and apart, without those whose value is shorter than ``least``.

    What lies between the matches, and the matches, give the places by their lengths in code points.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    parts = F.arrays_zip(whole.alias("w"), value.alias("v"), gaps.alias("g"))
    # The last gap has no match beside it.
    parts = F.filter(parts, lambda p: p["w"].isNotNull())
    spans = _let(parts, lambda ps: _let(
        _starts(F.transform(ps, lambda p: F.length(p["w"]) + p["g"])),
        lambda before: F.transform(ps, lambda p, i: F.struct(
            (F.get(before, i) + p["g"]).cast("int").alias("start"),
            (F.get(before, i) + p["g"] + F.length(p["w"])).cast("int").alias("end"),
            F.lit(kind).alias("kind"), p["v"].alias("value"),
        )),
    ))
    kept = F.filter(spans, lambda s: F.length(s["value"]) >= least)
    return F.transform(kept, lambda s: F.struct(s["start"], s["end"], s["kind"], F.sha2(s["value"], 256).alias("hash")))


def scan(docs: DataFrame) -> DataFrame:
    """Adds ``_base`` and ``_candidates`` to the rows: spans ``(start, end, kind, hash)`` in code points, by start and kind.

    A candidate is a run of 20 or more of the characters ``A-Za-z0-9+/_=-`` with a capital, a small
    letter and a digit that meets no base span. A null text is an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    finds = []
    for number, (kind, pattern, group, least) in enumerate(BASE):
        spans = _found(text, number, QUICK.get(kind, pattern), group, least)
        finds.append(F.when(text.rlike(SIEVE[kind]), spans).otherwise(none))
    rows = docs.withColumn("_base", F.array_sort(F.concat(*finds)))
    _, pattern, group, least = OWNED
    mixed = _found(text, len(BASE), pattern, group, least)
    runs = F.when(text.rlike(pattern), mixed).otherwise(none)
    apart = F.filter(runs, lambda r: ~F.exists(F.col("_base"), lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    looks = F.filter(apart, lambda r: _mixed(F.substring(text, r["start"] + 1, r["end"] - r["start"])))
    return rows.withColumn("_candidates", looks)


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def ownership(found: DataFrame) -> DataFrame:
    """``(hash, n_repositories, n_owners)`` of ``(repository, owner, spans)``: distinct holders of every value.

    A repository belongs to one owner: its rows under another owner count as another. Copies are combined before
    each shuffle, so a value that a third of all rows hold is no burden.
    """
    held = found.select("repository", "owner", F.explode(F.array_distinct(F.transform("spans", lambda s: s["hash"]))).alias("hash"))
    by_repository = held.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def find(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``(row, doc_id, spans)``, a row for each of ``docs`` (doc_id, text, source): spans with ``class`` and the holders of their value.

    The repository is the document, the owner its ``source``; a null source is an owner of its own, shared by all such rows. A value
    held by ``example_owners`` owners or more is an ``example``, any other is ``live``. Base spans of both classes stay; of the
    candidates only the live ones become spans, of the kind ``owned``. Spans are ordered by start, then kind. Repeated rows
    are rows of their own. ``row`` numbers the rows within this result.
    """
    plain = docs.select("doc_id", "text", "source")
    rows = scan(plain).select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", F.concat("_base", "_candidates").alias("spans"))
    rows = cut(rows)
    held = rows.where(F.size("spans") > 0).select("row", F.col("doc_id").alias("repository"), F.coalesce("source", F.lit("")).alias("owner"), "spans")
    owned = ownership(held)
    each = held.select("row", F.explode("spans").alias("s")).select("row", "s.*").join(owned, "hash")
    each = each.withColumn("class", F.when(F.col("n_owners") >= example_owners, "example").otherwise("live"))
    each = each.where((F.col("kind") < len(BASE)) | (F.col("class") == "live"))
    span = F.struct("start", "kind", "end", "class", "n_repositories", "n_owners", "hash")
    spans = each.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return rows.select("row", "doc_id").join(spans, "row", "left").withColumn("spans", F.coalesce("spans", empty))


def _listing(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    each = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def digests(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example)`` for each row of ``docs``."""
    found = find(docs, example_owners)
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))

    def size(of: Column) -> Column:
        return F.size(of).cast("long")

    def of_kind(number: int) -> Column:
        return size(F.filter(spans, lambda s: s["kind"] == number))

    counts = [of_kind(i).alias(f"n_{kind}") for i, (kind, *_) in enumerate(BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(_listing(base), 256).alias("base_sha256"), _listing(spans).alias("spans"),
        size(F.filter(spans, lambda s: s["class"] == "live")).alias("n_live"),
        size(F.filter(spans, lambda s: s["class"] == "example")).alias("n_example"),
    )


def mask(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """All rows of ``docs`` with their columns; spans in ``text`` become ``[SECRET]``, or ``[EXAMPLE]`` if widely copied.

    Spans that meet are masked as one, as a secret if any of them is. ``n_chars``, where there is such a column, follows the text.
    Other texts stay as they are, null ones too.
    """
    row = "_secret_row"
    kept = cut(scan(docs.withColumn(row, F.monotonically_increasing_id())))
    spans = F.concat("_base", "_candidates")
    held = kept.where(F.size(spans) > 0).select(row, F.col("doc_id").alias("repository"), F.coalesce("source", F.lit("")).alias("owner"), spans.alias("spans"))
    each = held.select(row, F.explode("spans").alias("s")).select(row, "s.*").join(ownership(held), "hash")
    live = F.col("n_owners") < example_owners
    each = each.where((F.col("kind") < len(BASE)) | live)
    found = each.groupBy(row).agg(F.sort_array(F.collect_list(F.struct("start", "end", live.alias("live")))).alias("_secret_spans"))
    empty = F.array().cast("array<struct<start:int,end:int,live:boolean>>")

    def join(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        merged = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), (last["live"] | s["live"]).alias("live"))
        meets = (F.size(done) > 0) & (s["start"] < F.try_element_at(done, F.lit(-1))["end"])
        return F.when(meets, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(merged))).otherwise(F.concat(done, F.array(s)))

    apart = F.aggregate("_secret_spans", empty, join)
    text = F.col("text")

    def rebuilt(all_spans: Column) -> Column:
        pieces = F.transform(all_spans, lambda s, i: F.concat(
            F.substring(text, F.coalesce(F.get(all_spans, i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(all_spans, i - 1)["end"], F.lit(0))),
            F.when(s["live"], F.lit("[SECRET]")).otherwise(F.lit("[EXAMPLE]")),
        ))
        rest = F.substring(text, F.element_at(all_spans, -1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), rest)

    # Only rows with a span move; a candidate that was turned down leaves a row without any.
    joined = kept.where(F.size(spans) > 0).join(found, row, "left")
    changed = F.col("_secret_spans").isNotNull()
    masked = joined.withColumn("text", F.when(changed, _let(apart, rebuilt)).otherwise(text))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.where(F.size(spans) == 0).select(*docs.columns).unionByName(masked.select(*docs.columns))
