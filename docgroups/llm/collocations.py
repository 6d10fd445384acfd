"""Phrase collocations of each language, counted by FM-indexes over shards of the documents.

Every task gathers the texts of a language into shards of bounded size, turns their words into ids and indexes them in both
directions (``fm_index``). Extending intervals word by word lists a shard's phrases of a length with their counts, which are
summed across shards. A phrase can only be frequent if the phrases it extends, on the left and on the right, are;
so lengths are counted in turn, and a shard extends only what a filter of the frequent shorter phrases lets through. The filter has a
fixed greatest size and no false negatives: a full one costs work, never a phrase.

Texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and tabs into words; A-Z are lower-cased. With ``a`` the count of
a phrase, ``l`` and ``r`` those of the parts a cut leaves, its score is ``floor(10**6 a a / (l r))`` at the lowest-scoring
cut, the first of these. A phrase goes if a longer frequent one holds it and has at least half of its occurrences.

Odd rows: a null text is empty, a null language is ``und`` (and joins a language of that name). Repeated rows count as often as they occur. A
language without a frequent phrase has no rows; an empty table gives none. A text longer than a shard is cut where
shards meet, with the words that phrases across the cut need on both sides. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgroups.llm.batches import bounded
from docgroups.llm.fm_index import BREAK, Index
from docgroups.session import cut

SHARD_BYTES = 3 << 20  # text of a language that is indexed at once, about half a million words
FILTER_BITS = 1 << 27  # greatest size of the filter of frequent phrases, 16 MB
BITS_PER_PHRASE, HASHES = 12, 3
OUT_ROWS = 100_000
SLICES = 64
_BREAK = b"\xff"  # never a byte of a text in UTF-8
_FOLD = bytes(255 if chr(c) in ".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


class PhraseFilter:
    """Bits of the phrases that may be frequent; tells phrases by hashes of their language and words."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def hashed(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))

    @staticmethod
    def combined(lang: str, columns: list[np.ndarray]) -> np.ndarray:
        """Hash of each phrase from the hashes of its words."""
        total = np.full(columns[0].size, xxhash.xxh3_64_intdigest(lang), dtype=np.uint64)
        for column in columns:
            total = (total ^ column) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        return total

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
        step = (hashes >> np.uint64(17)) | np.uint64(1)
        return [(hashes + np.uint64(i) * step) % np.uint64(size) for i in range(HASHES)]

    def passes(self, lang: str, columns: list[np.ndarray]) -> np.ndarray:
        kept = np.ones(columns[0].size, dtype=bool)
        for place in self.places(self.combined(lang, columns), self.bits.size * 64):
            kept &= (self.bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return kept


def phrase_filter(phrases: DataFrame, n_phrases: int) -> PhraseFilter:
    """The filter of a ``(lang, phrase)`` table. Its words of 64 bits are combined by Spark; at most FILTER_BITS reach the driver."""
    size = 64
    while size < BITS_PER_PHRASE * n_phrases and size < FILTER_BITS:
        size *= 2

    def set_bits(batches):
        for batch in batches:
            words = [p.split(b" ") for p in batch["phrase"].cast(pa.binary()).to_pylist()]
            langs = batch["lang"].to_pylist()
            parts = defaultdict(list)
            for lang, own in zip(langs, words):
                parts[lang, len(own)].append(own)
            found = [np.zeros(0, np.uint64)]
            for (lang, _), own in parts.items():
                hashes = PhraseFilter.combined(lang, [PhraseFilter.hashed(list(column)) for column in zip(*own)])
                found += PhraseFilter.places(hashes, size)
            place = np.unique(np.concatenate(found))
            at, first = np.unique(place >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (place & np.uint64(63)), first) if place.size else place
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(bits.view(np.int64))], names=["at", "bits"])

    found = phrases.select("lang", "phrase").mapInArrow(set_bits, "at long, bits long")
    table = found.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(size // 64, dtype=np.uint64)
    bits[table["at"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return PhraseFilter(bits)


def word_ids(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Ids of the words of a folded text, BREAK between pieces, and the words; that of id 0 is the break."""
    table = defaultdict(count().__next__)
    table[_BREAK]
    tokens = text.replace(_BREAK, b" \xff ").split()
    ids = np.fromiter(map(table.__getitem__, tokens), dtype=np.int32, count=len(tokens))
    return ids, list(table)


def shards(batches: Iterator, overlap: int, shard_bytes: int) -> Iterator[tuple[str, bytes]]:
    """``(language, folded text)`` of up to about ``shard_bytes``; parts of one long text share ``overlap`` words."""
    held, sizes = defaultdict(list), defaultdict(int)
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
            folded, again = (text or b"").translate(_FOLD), b""
            while len(folded) > shard_bytes:
                # Up to the end of a word, past those of the part before, however long they are; what follows starts ``overlap`` words before it.
                end = folded.find(b" ", max(shard_bytes, len(again) + 1))
                end = len(folded) if end < 0 else end
                yield lang, folded[:end]
                again = _last_words(folded[:end], overlap)
                folded = again + folded[end:] if end < len(folded) else b""
            held[lang].append(folded)
            sizes[lang] += len(folded)
            if sizes[lang] >= shard_bytes:
                yield lang, _BREAK.join(held.pop(lang))
                sizes.pop(lang)
    for lang, parts in held.items():
        yield lang, _BREAK.join(parts)


def _last_words(folded: bytes, n: int) -> bytes:
    """The last ``n`` words of the last piece, or as many as it has."""
    words = folded[folded.rfind(_BREAK) + 1:].split() if n else []
    return b" ".join(words[-n:]) if n else b""


def _frequent_only(ids: np.ndarray, words: list[bytes], kept: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Words that cannot be part of a frequent phrase become breaks; runs of breaks become one."""
    kept[BREAK] = True
    new = np.cumsum(kept) - 1
    ids = np.where(kept[ids], new[ids], BREAK)
    ids = np.concatenate([[BREAK], ids, [BREAK]])
    ids = ids[np.concatenate([[True], (ids[1:] != BREAK) | (ids[:-1] != BREAK)])]
    return ids, [w for w, k in zip(words, kept) if k]


def shard_phrases(lang: str, text: bytes, length: int, filters: list[PhraseFilter]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Phrases of a length as word ids, their counts, and the words of the ids. ``filters[i]`` holds phrases of i + 1 words."""
    ids, words = word_ids(text)
    if length == 1:
        times = np.bincount(ids, minlength=len(words))
        times[BREAK] = 0
        found = np.flatnonzero(times)
        return found[:, None], times[found], words
    hashes = PhraseFilter.hashed(words)
    ids, words = _frequent_only(ids, words, filters[0].passes(lang, [hashes]))
    hashes = PhraseFilter.hashed(words)
    if len(words) == 1:
        return np.zeros((0, length), np.int64), np.zeros(0, np.int64), words
    index = Index(ids, length)
    phrases = index.single()
    for have in range(1, length):
        # To the left and to the right by turns: both intervals are at hand.
        phrases = index.left(phrases) if have % 2 else index.right(phrases)
        if have + 1 < length:
            shorter = filters[have]
            phrases = phrases.where(shorter.passes(lang, [hashes[c] for c in phrases.words.T]))
        elif length > 2:
            # The other phrase of one word less that this one extends.
            other = phrases.words[:, :-1] if have % 2 else phrases.words[:, 1:]
            phrases = phrases.where(filters[have - 1].passes(lang, [hashes[c] for c in other.T]))
    return phrases.words, phrases.count, words


def phrase_counts(docs: DataFrame, length: int, filters: list[PhraseFilter], shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(lang, phrase, count)`` of all phrases of a length that the filters let through, summed across shards."""

    def mine(batches):
        for lang, text in shards(batches, length - 1, shard_bytes):
            phrases, times, words = shard_phrases(lang, text, length, filters)
            names = pa.array(words, pa.binary())
            for at in range(0, len(phrases), OUT_ROWS):
                part = phrases[at:at + OUT_ROWS]
                parts = [names.take(pa.array(column)).cast(pa.string()) for column in part.T]
                joined = pc.binary_join_element_wise(*parts, " ") if length > 1 else parts[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), joined, pa.array(times[at:at + OUT_ROWS].astype(np.int64))], names=["lang", "phrase", "count"]
                )

    found = bounded(docs).mapInArrow(mine, "lang string, phrase string, count long")
    return found.groupBy("lang", "phrase").agg(F.sum("count").alias("count"))


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` at the lowest-scoring cut. ``parts`` has the counts of all phrases that a cut can leave."""
    words = F.split("phrase", " ")
    cuts = phrases.select("lang", "phrase", F.col("count").alias("a"), words.alias("words"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.col("words"), 1, F.col("k")).alias("head"), _part(F.col("words"), F.col("k") + 1, F.size("words")).alias("tail"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("count").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("tail"), F.col("count").alias("r")), ["lang", "tail"])
    # Exact: decimals of 38 digits hold the products, and the integer division rounds down.
    score = F.expr("(cast(1000000 as decimal(7, 0)) * (cast(a as decimal(15, 0)) * cast(a as decimal(15, 0)))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "low.l", "low.r", "low.score")


def covered(phrases: DataFrame) -> DataFrame:
    """``(lang, phrase, longer)``: for phrases inside longer ones, the largest count of those."""
    words = F.split("phrase", " ")
    each = phrases.select("lang", F.col("count").alias("longer"), words.alias("w")).where(F.size("w") > 2)
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("w") - n + 1), lambda start: F.array_join(F.slice("w", start, n), " ")
    )))
    return each.select("lang", "longer", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))


def mine(
    docs: DataFrame, max_words: int = 3, min_count: int = 10, longer_share: int = 50, top: int = 2000, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of 2 to ``max_words`` words.

    ``docs`` is ``(lang, text)``. Phrases occur ``min_count`` times or more; one goes if a longer one has ``longer_share`` percent of its
    occurrences. By score, then count, both falling, then the phrase in the order of its bytes.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = cut(phrase_counts(docs, 1, [], shard_bytes))
    totals = words.groupBy("lang").agg(F.sum("count").alias("n"))
    kept, filters = [words.where(F.col("count") >= min_count)], []
    for length in range(2, max_words + 1):
        filters.append(phrase_filter(kept[-1], kept[-1].count()))
        kept.append(cut(phrase_counts(docs, length, filters, shard_bytes).where(F.col("count") >= min_count)))
    phrases = kept[1]
    for more in kept[2:]:
        phrases = phrases.unionByName(more)
    alone = phrases.join(covered(phrases), ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(longer_share) * F.col("count"))
    )
    found = scored(alone.select("lang", "phrase", "count"), kept[0].unionByName(phrases))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within slices of a language, so that one language is never sorted whole in one task.
    found = found.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    near = found.withColumn("place", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("place") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
