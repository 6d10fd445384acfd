"""Language of texts and of their spans.

Script ranges narrow the languages a word can have; character trigrams score the rest; a Viterbi pass with
a switching penalty labels every word, so a text may hold spans of several languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgroups.llm import chars
from docgroups.llm.batches import bounded, give_back

BUCKETS = 1 << 16
SAMPLE_PER_LANGUAGE = 3000
SWITCH_PENALTY = 12.0
RUN_CHARS = 4 * chars.CHUNK  # texts labelled together
SCORED_CHARS = chars.CHUNK // 2  # of them scored at once
SMOOTHING = 0.1
SCRIPT_SHARE = 0.005
UNDETERMINED = "und"


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # log probability, BUCKETS x languages
    allowed: np.ndarray  # scripts x languages
    prior: np.ndarray


def held_out(doc_id: Column) -> Column:
    """The quarter that is never learned from: crc32 of the id as text has the remainder 2; a null id isn't in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _grams(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets and the word of each; zero stands before and after a word.

    A word of n characters has n + 1 of them: one ending at each character and one at its end.
    """
    lengths = ends - starts
    word = np.repeat(np.arange(len(starts)), lengths + 1)
    shift = np.cumsum(lengths + 1) - (lengths + 1)
    place = np.arange(len(word)) - shift[word]
    at = starts[word] + place
    lower = chars.tables()["lower"][points].astype(np.uint64)
    padded = np.concatenate([lower, np.zeros(1, np.uint64)])
    last = np.where(place < lengths[word], padded[at], np.uint64(0))
    before = np.where(place >= 1, padded[at - 1], np.uint64(0))
    first = np.where(place >= 2, padded[at - 2], np.uint64(0))
    key = (first << np.uint64(42)) | (before << np.uint64(21)) | last
    return (chars.mix(key) & np.uint64(BUCKETS - 1)).astype(np.int64), shift


def _script(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return chars.tables()["script"][points[starts]].astype(np.int64)


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Trigram and script counts by ``lang`` over ``(doc_id, text, lang)``.

    Learns from about ``per_language`` texts of each language, chosen by the hash of their id; rows without
    a text or language don't count. The counts that come to the driver are at most BUCKETS a language.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((chars.N_SCRIPTS, 0), bool), np.zeros(0))
    parts = 1 << 20
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, int(per_language / sizes[lang] * parts))])
    code = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, codes = batch.column("text").to_pylist(), np.array(batch.column("code"))
            total = np.zeros((len(langs), BUCKETS + chars.N_SCRIPTS), dtype=np.int64)
            for first, end, points, offsets in chars.chunks(texts):
                starts, ends = chars.words(points)
                if not len(starts):
                    continue
                lang = codes[first:end][np.searchsorted(offsets, starts, side="right") - 1]
                grams, shift = _grams(points, starts, ends)
                per_word = np.diff(np.append(shift, len(grams)))
                np.add.at(total, (np.repeat(lang, per_word), grams), 1)
                np.add.at(total, (lang, BUCKETS + _script(points, starts)), ends - starts)
            lang, slot = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(slot, pa.int32()), pa.array(total[lang, slot])], ["lang", "slot", "n"])
        give_back()

    rows = bounded(sample.select("text", code[F.col("lang")].alias("code"))).mapInArrow(count, "lang int, slot int, n long")
    found = rows.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), BUCKETS + chars.N_SCRIPTS))
    counts[found["lang"], found["slot"]] = found["n"]
    grams, scripts = counts[:, :BUCKETS], counts[:, BUCKETS:]
    weights = np.log((grams + SMOOTHING) / (grams.sum(1, keepdims=True) + SMOOTHING * BUCKETS)).T
    allowed = (scripts > 0) & (scripts >= SCRIPT_SHARE * scripts.sum(1, keepdims=True))
    prior = np.array([sizes[lang] for lang in langs], float)
    return Model(langs, np.ascontiguousarray(weights), allowed.T, np.log(prior / prior.sum()))


def emissions(model: Model, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Log probability of each word by language; languages whose texts don't use its script are out.

    A word in a script that no language uses says nothing.
    """
    if not len(starts):
        return np.zeros((0, len(model.langs)))
    grams, shift = _grams(points, starts, ends)
    scores = np.empty((len(starts), len(model.langs)))
    for i in range(len(model.langs)):
        scores[:, i] = np.add.reduceat(model.weights[:, i][grams], shift)
    allowed = model.allowed[_script(points, starts)]
    none = ~allowed.any(axis=1)
    scores = np.where(allowed, scores, -1e6)
    scores[none] = 0
    return scores - scores.max(axis=1, keepdims=True)


def viterbi(scores: np.ndarray, offsets: np.ndarray, prior: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word: texts take ``scores[offsets[i]:offsets[i + 1]]``, a change costs ``penalty``.

    Texts advance together, the longest first, so a step is a few array operations over all that still run.
    Staying wins ties with a change; among labels the first wins.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = offsets[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(steps), side="left")
    best_of = np.empty(len(scores), dtype=np.int16)  # best label up to a word
    changed = np.zeros(scores.shape, dtype=bool)  # label of a word follows a change
    path = np.empty(len(scores), dtype=np.int16)
    for t in range(steps):
        n = running[t]
        at = begin[:n] + t
        if t == 0:
            value = scores[at] + prior
        else:
            value = value[:n]
            jump = value.max(axis=1, keepdims=True) - penalty
            changed[at] = jump > value
            value = np.maximum(value, jump) + scores[at]
        best_of[at] = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = running[t]
        at = begin[:n] + t
        more = running[t + 1] if t + 1 < steps else 0
        path[at[more:]] = best_of[at[more:]]
        if more:
            following = at[:more] + 1
            label = path[following]
            path[at[:more]] = np.where(changed[following, label], best_of[at[:more]], label)
    return path


def _label(model: Model, texts: list[str | None], penalty: float) -> Iterator[tuple[list, list, list]]:
    """For runs of texts: labels, shares and spans ``(start, end, lang)``."""
    for first, end, points, offsets in chars.chunks(texts, RUN_CHARS):
        n, langs = end - first, len(model.langs)
        if not langs:
            yield [UNDETERMINED] * n, [0.0] * n, [[]] * n
            continue
        starts, ends, scores = [], [], []
        cut = 0
        while cut < n:  # scores of a few texts at a time: their trigrams take more room than their words
            stop = max(cut + 1, int(np.searchsorted(offsets, offsets[cut] + SCORED_CHARS, side="right")) - 1)
            part = points[offsets[cut]:offsets[stop]]
            s, e = chars.words(part)
            scores.append(emissions(model, part, s, e))
            starts.append(s + offsets[cut])
            ends.append(e + offsets[cut])
            cut = stop
        starts, ends, scores = np.concatenate(starts), np.concatenate(ends), np.concatenate(scores)
        bounds = np.searchsorted(starts, offsets)
        path = viterbi(scores, bounds, model.prior, penalty)
        doc = np.repeat(np.arange(n), np.diff(bounds))
        weight = np.bincount(doc * langs + path, weights=ends - starts, minlength=n * langs).reshape(n, langs)
        total = weight.sum(axis=1)
        top = weight.argmax(axis=1)
        share = weight[np.arange(n), top] / np.maximum(total, 1)
        fresh = np.ones(len(path), dtype=bool)
        fresh[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(fresh)
        spans: list[list] = [[] for _ in range(n)]
        for h in heads.tolist():
            d = int(doc[h])
            begin = int(starts[h] - offsets[d]) if spans[d] else 0
            if spans[d]:
                spans[d][-1]["end"] = begin
            spans[d].append({"start": begin, "end": int(offsets[d + 1] - offsets[d] - 1), "lang": model.langs[path[h]]})
        yield (
            [model.langs[i] if w > 0 else UNDETERMINED for i, w in zip(top.tolist(), total.tolist())],
            np.where(total > 0, share, 0.0).tolist(), spans,
        )


SPANS = "array<struct<start:int,end:int,lang:string>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``(doc_id, lang_pred, score, spans)`` for every row of ``(doc_id, text)``; other columns are ignored.

    The prediction is the language with most letters, the score its share of them, 0 to 1. Spans cover the
    whole text; one begins where the text or a word of another language does, in code points. A text that is
    null or has no letter is ``und`` with score 0 and no span; so is any text if nothing could be learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, shares, spans = [], [], []
            for a, b, c in _label(shared.value, batch.column("text").to_pylist(), penalty):
                langs += a
                shares += b
                spans += c
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, SPAN_TYPE)],
                ["doc_id", "lang_pred", "score", "spans"],
            )
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs.select("doc_id", "text")).mapInArrow(label, f"doc_id {kind}, lang_pred string, score double, spans {SPANS}")


def keep_identified(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with all their columns; a text without one is ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [x for part in _label(shared.value, batch.column("text").to_pylist(), penalty) for x in part[0]]
            yield batch.filter(pa.array([x != UNDETERMINED for x in labels], pa.bool_()))
        give_back()

    return bounded(docs).mapInArrow(sift, docs.schema)
