"""Paragraph fingerprints, ranked search and collocations against brute force, with odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docgroups.llm import collocations, lexical_rank, paragraph_sketch
from docgroups.llm.fm_index import Index

WORDS = ["red", "Blue", "green", "Ünï", "x", "stone", "of", "the"]


def made_text(rng, n):
    ends = [" "] * 8 + [". ", "\n", ", ", "! "]
    return "".join(rng.choice(WORDS) + rng.choice(ends) for _ in range(n))


def odd_documents(spark, n=60):
    """Nulls, empty and long texts, repeated rows, ties, extra columns with the names that the operators use inside."""
    rng = random.Random(5)
    rows = [(i, made_text(rng, rng.randrange(1, 80)), rng.choice(["en", "de", None, "und"])) for i in range(n)]
    rows += [(n, None, "en"), (n + 1, "", None), (n + 2, "...\n\n!", "de"), (n + 3, made_text(rng, 4000), "en"), (n + 4, rows[3][1], "en")]
    rows += [rows[0], rows[1]]
    return spark.createDataFrame(
        [(*r, 1, 2.0, "c", 7) for r in rows], "doc_id long, text string, lang string, n int, score double, count string, hash int"
    ), rows


# Paragraph fingerprints


def plain_digests(text):
    found = dict.fromkeys(p for p in re.findall(paragraph_sketch.PARAGRAPH, text or "") if p)
    return {int(hashlib.md5(p.encode()).hexdigest()[:15], 16) for p in found}


def plain_check(k):
    a, b, c = (k >> 20 * t & (1 << 20) - 1 for t in range(3))
    return sum(s % (2**31 - 1) * f for s, f in zip((a * a, b * b, c * c, a * b, b * c), (524287, 131071, 8191, 127, 31))) % (2**31 - 1)


def plain_fingerprint(text):
    cells = {}
    for k in plain_digests(text):
        for t in range(3):
            at = (k >> 20 * t & (1 << 20) - 1) % 16 + 16 * t
            n, x, c = cells.get(at, (0, 0, 0))
            cells[at] = (n + 1, x ^ k, c ^ plain_check(k))
    return " ".join(f"{at:X}.{n:X}.{x:X}.{c:X}" for at, (n, x, c) in sorted(cells.items()))


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_odd_rows_equal_brute_force(spark):
    docs, rows = odd_documents(spark)
    found = defaultdict(list)
    for r in paragraph_sketch.compare(docs).collect():
        found[r["doc_id"]].append(r)
    distinct = sorted({(r[0], r[1] or "") for r in rows})
    assert sum(map(len, found.values())) == len(rows)
    for at, (doc_id, text) in enumerate(distinct):
        after = distinct[(at + 1) % len(distinct)][1]
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + after[:quarter]
        assert len(found[doc_id]) == sum(r[0] == doc_id for r in rows)
        for r in found[doc_id]:
            assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert r["fingerprint"] == plain_fingerprint(text) and r["edited_fingerprint"] == plain_fingerprint(edited)
            assert r["near_edited"] == likeness(plain_digests(text), plain_digests(edited))
            assert r["near_next"] == likeness(plain_digests(text), plain_digests(after))


def test_fingerprints_of_null_ids_one_document_and_no_rows(spark):
    schema = "doc_id long, text string"
    rows = paragraph_sketch.compare(spark.createDataFrame([(None, "One. Two."), (0, "One. Two."), (None, None)], schema)).collect()
    assert len(rows) == 3 and sorted(r["n_chars"] for r in rows) == [0, 9, 9]
    alone = paragraph_sketch.compare(spark.createDataFrame([(4, "abcdefgh")], schema)).first()
    assert alone["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and alone["near_next"] == 1.0
    assert paragraph_sketch.compare(spark.createDataFrame([], schema)).isEmpty()


def test_peeling_names_the_differing_digests_and_small_sketches_fail(spark):
    rng = random.Random(1)
    digests = [rng.getrandbits(60) for _ in range(400)]
    first, second = digests[:380], digests[20:]
    versions = spark.createDataFrame([(1, 0, first, second), (2, 0, first, first), (3, 0, [], digests)], "id0 long, hash long, a array<long>, b array<long>")
    signed = versions.select("id0", F.explode(paragraph_sketch._signed(F.col("a"), F.col("b"), 0)).alias("e")).select("id0", "e.*")
    left = paragraph_sketch.peel(paragraph_sketch.sketch(signed, ["id0"], 64), ["id0"], 64, cycles=10, digests=True)
    of_first = {r["found"] for r in left.where("id0 = 1 and cell = -1").collect()}
    of_second = {r["found"] for r in left.where("id0 = 1 and cell = -2").collect()}
    assert of_first == set(first) - set(second) and of_second == set(second) - set(first)
    assert left.where("id0 = 1 and cell >= 0").isEmpty() and left.where("id0 = 2").isEmpty()
    assert not left.where("id0 = 3 and cell >= 0").isEmpty()  # 400 digests do not fit
    found = paragraph_sketch.differences(versions, ["id0", "hash"], [("a", "b")], size=4)
    assert {r["id0"]: r["differing"] for r in found.collect()} == {1: 40, 3: 400}


# Ranked search


def plain_terms(text):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", fold)


def plain_ranking(docs, items, k):
    counts = [(d[0], Counter(plain_terms(d[1]))) for d in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for item_id, text in items:
        wanted[item_id] |= set(plain_terms(text))
    out = []
    for item_id, terms in wanted.items():
        scored = []
        for doc_id, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scored.append((-s, doc_id))
        out += [(item_id, rank, doc_id, -s) for rank, (s, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("item_bytes", [1 << 20, 60])
def test_ranking_of_odd_rows_equals_brute_force(spark, item_bytes):
    docs, rows = odd_documents(spark)
    items = [(1, "Red stone"), (2, None), (3, "nothing known"), (4, "of THE x"), (4, "green"), (5, "Ünï ÜNÏ"), (6, "")]
    table = spark.createDataFrame([(*i, 0, 1) for i in items], "item_id long, text string, term int, rank int")
    found = lexical_rank.rank(docs, table, 7, item_bytes)
    assert sorted(map(tuple, found.collect())) == plain_ranking(rows, items, 7)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_ranking_of_empty_tables(spark):
    docs, _ = odd_documents(spark, 5)
    items = spark.createDataFrame([(1, "red")], "item_id long, text string")
    assert lexical_rank.rank(docs, items.limit(0)).isEmpty() and lexical_rank.rank(docs.limit(0), items).isEmpty()


def test_tied_copies_rank_by_id(spark):
    rows = [(i, "red stone") for i in range(3000, 0, -1)] + [(None, "red stone")] + [(i, "blue sky") for i in range(5000, 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = lexical_rank.rank(docs, spark.createDataFrame([(9, "red")], "item_id long, text string"), 50).orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == list(range(1, 51)) and len({r["score"] for r in found}) == 1


def test_columns_end_before_sums_lose_bits():
    w = np.array([10**9, 85 * 10**8, 10**9, 3])
    tiles = lexical_rank.item_tiles(np.zeros(4, int), np.arange(4), w, 1)
    blocks = tiles[0][1]
    assert [b.tolist() for b, _ in blocks] == [[0], [1], [2, 3]]
    assert all(m.sum() * lexical_rank.MOST_IMPACT < lexical_rank.EXACT for _, m in blocks)


# Collocations


def plain_collocations(docs, max_words=3, min_count=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, max_words + 1):
                f.update((lang or "und", tuple(words[i:i + size])) for i in range(len(words) - size + 1))
    candidates = {p: c for p, c in f.items() if len(p[1]) >= 2 and c >= min_count}
    dropped = set()
    for (lang, w), c in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                if 100 * c >= 50 * f[lang, w[i:i + size]]:
                    dropped.add((lang, w[i:i + size]))
    rows = defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in dropped:
            score, _, left, right = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            rows[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in rows.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


@pytest.mark.parametrize("max_words, shard_bytes", [(2, 1 << 20), (3, 1 << 20), (3, 700), (4, 300)])
def test_collocations_of_odd_rows_equal_brute_force(spark, max_words, shard_bytes):
    docs, rows = odd_documents(spark)
    found = collocations.mine(docs.coalesce(2), max_words, shard_bytes=shard_bytes)
    assert sorted(map(tuple, found.collect())) == plain_collocations([(r[2], r[1]) for r in rows], max_words)


def test_collocations_without_rows_or_frequent_phrases(spark):
    schema = "lang string, text string"
    assert collocations.mine(spark.createDataFrame([], schema)).isEmpty()
    assert collocations.mine(spark.createDataFrame([("en", "a b c"), (None, None)], schema)).isEmpty()


def test_a_piece_longer_than_a_shard_and_any_bytes(spark):
    text = "a b \x00 c\x1cd " * 200 + "e" * 500 + " a b"
    found = collocations.mine(spark.createDataFrame([("en", text)], "lang string, text string"), 3, shard_bytes=50)
    assert sorted(map(tuple, found.collect())) == plain_collocations([("en", text)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60))
def test_intervals_count_all_phrases(words):
    ids = np.array([0, *words, 0], dtype=np.int32)
    if not any(words):
        return
    index, plain = Index(ids, 4), Counter()
    for size in range(1, 5):
        plain.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1) if all(words[i:i + size]))
    for turns in ("lll", "rrr", "lrl", "rlr"):
        phrases, found = index.single(), {}
        for turn in ("", *turns):
            phrases = index.left(phrases) if turn == "l" else index.right(phrases) if turn == "r" else phrases
            found |= {tuple(map(int, w)): int(c) for w, c in zip(phrases.words, phrases.count) if c}
        assert found == dict(plain)


def test_a_filter_keeps_all_its_phrases(spark):
    phrases = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "en").otherwise("de").alias("lang"), F.concat(F.col("id").cast("string"), F.lit(" x")).alias("phrase"))
    held = collocations.phrase_filter(phrases, 3000)
    words = [str(i).encode() for i in range(3000)]
    columns = [held.hashed(words), held.hashed([b"x"] * 3000)]
    own = np.array(["en" if i % 3 == 0 else "de" for i in range(3000)])
    for lang in ("en", "de"):
        kept = held.passes(lang, columns)
        assert kept[own == lang].all() and kept[own != lang].mean() < 0.05
