"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other; each model also sees the probabilities of the categories
before it. For training these come from models that have not seen the row (out of fold).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgroups.llm import chars
from docgroups.llm.batches import bounded, give_back

SAMPLE_ROWS = 12_000
FOLDS = 5
TERMS = 384
MIN_ROWS = 5
RIDGE = 0.3
NEWTON_STEPS = 25
STEM_LENGTHS = (4, 5, 6)
N_STYLE = 6
THRESHOLD = 0.4


@dataclass
class Model:
    categories: list[str]
    terms: np.ndarray  # sorted hashes
    weights: list[np.ndarray]  # of a category: intercept, terms, style, earlier categories


def _features(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first, end, text of each term, term, style)``: terms are hashes of words and of their first letters.

    Words are lower-cased; a term may repeat in a text. Style: log length, share of letters, of capitals
    among letters, of digits and of signs, and the mean length of words.
    """
    t, power = chars.tables(), chars.powers()
    for first, end, points, offsets in chars.chunks(texts):
        n = end - first
        starts, ends = chars.words(points)
        lower = chars.mix(t["lower"][points].astype(np.uint64) + np.uint64(1))
        doc = np.searchsorted(offsets, starts, side="right") - 1
        length = ends - starts
        docs, terms = [doc], [chars.run_hashes(lower, starts, ends)]
        for k in STEM_LENGTHS:
            long = np.flatnonzero(length > k)
            stem = np.zeros(len(long), dtype=np.uint64)
            for i in range(k):
                stem += lower[starts[long] + i] * power[i]
            docs.append(doc[long])
            terms.append(chars.mix(stem + np.uint64(k)))

        def per_text(flags: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flags)])
            return np.diff(sums[offsets]).astype(float)  # noqa: B023  used before the next round

        letters, size = per_text(t["letter"][points]), np.maximum(np.diff(offsets) - 1, 1)
        signs = per_text(~(t["word"] | t["digit"] | t["blank"])[points])
        n_words = np.bincount(doc, minlength=n)
        style = np.stack([
            np.log1p(np.diff(offsets) - 1) / 10, letters / size, per_text(t["upper"][points]) / np.maximum(letters, 1),
            per_text(t["digit"][points]) / size, signs / size, np.bincount(doc, length, n) / np.maximum(n_words, 1) / 10,
        ], axis=1)
        yield first, end, np.concatenate(docs), np.concatenate(terms).view(np.int64), style


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is the intercept and has no penalty.

    With one class only, the intercept alone tells it.
    """
    if not len(y) or y.min() == y.max():
        w = np.zeros(x.shape[1])
        w[0] = 10.0 if len(y) and y[0] else -10.0
        return w
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(NEWTON_STEPS):
        p = _sigmoid(x @ w)
        curve = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x.T * curve) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return w


def _matrix(hits: list, style: list, earlier: list, n_terms: int) -> np.ndarray:
    x = np.zeros((len(hits), 1 + n_terms + N_STYLE + len(earlier)))
    x[:, 0] = 1
    for i, found in enumerate(hits):
        x[i, 1 + np.asarray(found, dtype=np.int64)] = 1
    x[:, 1 + n_terms:1 + n_terms + N_STYLE] = np.stack(style) if len(hits) else 0
    for i, p in enumerate(earlier):
        x[:, 1 + n_terms + N_STYLE + i] = p
    return x


def _known(texts: list[str | None], terms: np.ndarray) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray]]:
    """For runs of texts: the places in ``terms`` that each holds, and its style."""
    for first, end, doc, found, style in _features(texts):
        at = np.minimum(np.searchsorted(terms, found), max(len(terms) - 1, 0))
        hit = terms[at] == found if len(terms) else np.zeros(len(found), bool)
        pairs = np.unique(doc[hit] * max(len(terms), 1) + at[hit])
        owner, place = pairs // max(len(terms), 1), pairs % max(len(terms), 1)
        cut = np.searchsorted(owner, np.arange(end - first + 1))
        yield first, end, [place[cut[i]:cut[i + 1]] for i in range(end - first)], style


def sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, text, fold, y)`` of about ``rows`` labelled texts, chosen by the hash of their id.

    ``categories`` maps a name to a condition on a row of ``labels``. Labels with a null id or a null
    category don't count; of several for one id, a category holds if any says so.
    """
    named = labels.select("doc_id", *[c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())]).dropna()
    parts = 1 << 20
    share = F.lit(min(1.0, rows / max(named.count(), 1)) * parts)
    chosen = named.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(parts)) < share)
    y = F.array(*[F.max(f"y{i}") for i in range(len(categories))])
    chosen = chosen.groupBy("doc_id").agg(y.alias("y"))  # bounded by ``rows``, so broadcast
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", fold, "y")


def choose_terms(rows: DataFrame, n_categories: int, n_terms: int = TERMS) -> np.ndarray:
    """Sorted hashes of the terms that tell most about a category, by the chi-square of presence."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            y = np.array(batch.column("y").to_pylist(), dtype=np.int64).reshape(len(texts), n_categories)
            for first, end, doc, found, _ in _features(texts):
                order = np.lexsort((found, doc))
                doc, found = doc[order], found[order]
                fresh = np.ones(len(doc), bool)
                fresh[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
                term, place = np.unique(found[fresh], return_inverse=True)
                per = [pa.array(np.bincount(place, y[first:end][doc[fresh], c], len(term)).astype(np.int64)) for c in range(n_categories)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term), pa.array(np.bincount(place, minlength=len(term))), *per],
                    ["term", "n", *[f"y{c}" for c in range(n_categories)]],
                )
        give_back()

    shape = ", ".join(["term long", "n long", *[f"y{c} long" for c in range(n_categories)]])
    totals = rows.agg(F.count("*").alias("n"), *[F.sum(F.col("y")[c]).alias(f"y{c}") for c in range(n_categories)]).first()
    counted = bounded(rows).mapInArrow(count, shape).groupBy("term").agg(F.sum("n").alias("n"), *[F.sum(f"y{c}").alias(f"y{c}") for c in range(n_categories)])
    counted = counted.where(F.col("n") >= MIN_ROWS)
    best: set[int] = set()
    scores = []
    for c in range(n_categories):
        if not totals["n"] or not totals[f"y{c}"] or totals[f"y{c}"] == totals["n"]:
            continue
        expected = F.col("n") * (totals[f"y{c}"] / totals["n"])
        gap = F.col(f"y{c}") - expected
        scores.append((gap * gap / expected / (1 - F.col("n") / (totals["n"] + 1.0))).alias(f"s{c}"))
    if scores:
        # One pass for all categories: the terms of each are the top rows of one small sort.
        scored = counted.select("term", *scores).persist()
        for name in scored.columns[1:]:
            best |= {r["term"] for r in scored.orderBy(F.desc(name), "term").limit(n_terms // len(scores)).collect()}
        scored.unpersist()
    return np.array(sorted(best), dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], rows: int = SAMPLE_ROWS) -> Model:
    """A chain in the order of ``categories``, learned from a sample of at most about ``rows`` labelled texts.

    Every fit is one task over the sample: for each fold, the model of the other folds scores it; the model
    of all folds is kept.
    """
    n = len(categories)
    table = sample(docs, labels, categories, rows).persist()
    held = [table]
    terms = choose_terms(table, n)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, style = [], []
            for _, _, places, looks in _known(batch.column("text").to_pylist(), terms):
                hits += [x.tolist() for x in places]
                style += looks.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("fold"), batch.column("y"), pa.array(hits, pa.list_(pa.int64())), pa.array(style, pa.list_(pa.float64()))],
                ["doc_id", "fold", "y", "hits", "style"],
            )
        give_back()

    kind = table.schema["doc_id"].dataType.simpleString()
    rows_in = bounded(table).mapInArrow(known, f"doc_id {kind}, fold int, y array<int>, hits array<long>, style array<double>")
    rows_in = rows_in.withColumn("earlier", F.array().cast("array<double>")).persist()
    held.append(rows_in)
    weights = []

    def fitting(c: int):
        def fit_one(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(["doc_id", "fold"], kind="stable")  # the same sums whatever the order of arrival
            left_out = int(part["task"].iloc[0])
            x = _matrix(part["hits"].tolist(), part["style"].tolist(), list(np.stack(part["earlier"]).T) if c else [], len(terms))
            y = np.stack(part["y"])[:, c].astype(float)
            inner = (part["fold"] != left_out).to_numpy()
            w = fit(x[inner], y[inner])
            outer, p = part["doc_id"][~inner], _sigmoid(x[~inner] @ w)
            del part, x
            give_back()
            if left_out < 0:
                return pd.DataFrame({"doc_id": [None], "w": [w.tolist()], "p": [None]})
            return pd.DataFrame({"doc_id": outer, "w": [None] * len(outer), "p": p})

        return fit_one

    for c in range(n):
        tasks = F.explode(F.array(*[F.lit(i) for i in range(-1, FOLDS if c + 1 < n else 0)])).alias("task")
        shape = f"doc_id {kind}, w array<double>, p double"
        fits = rows_in.select("*", tasks).groupBy("task").applyInPandas(fitting(c), shape).persist()
        held.append(fits)
        kept = fits.where("w IS NOT NULL").select("w").collect()
        weights.append(np.array(kept[0]["w"]) if kept else _constant(len(terms), c))
        if c + 1 < n:
            scored = fits.where("w IS NULL").groupBy("doc_id").agg(F.max("p").alias("p"))
            rows_in = rows_in.join(scored, "doc_id").withColumn("earlier", F.concat("earlier", F.array("p"))).drop("p").persist()
            held.append(rows_in)
    for kept_rows in held:
        kept_rows.unpersist()
    return Model(list(categories), terms, weights)


def _constant(n_terms: int, earlier: int) -> np.ndarray:
    w = np.zeros(1 + n_terms + N_STYLE + earlier)
    w[0] = -10.0
    return w


def _score(model: Model, texts: list[str | None]) -> np.ndarray:
    """Probabilities, texts x categories."""
    parts, n_terms = [], len(model.terms)
    for first, end, places, style in _known(texts, model.terms):
        out = np.zeros((end - first, len(model.categories)))
        for c, w in enumerate(model.weights):
            terms = w[1:1 + n_terms]
            base = np.array([terms[found].sum() for found in places])
            out[:, c] = _sigmoid(w[0] + base + style @ w[1 + n_terms:1 + n_terms + N_STYLE] + out[:, :c] @ w[1 + n_terms + N_STYLE:])
        parts.append(out)
    return np.concatenate(parts) if parts else np.zeros((0, len(model.categories)))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, p_<category> ...)`` for every row of ``(doc_id, text)``; a null text is scored as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"p_{c}" for c in model.categories]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _score(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(p[:, i]) for i in range(len(names))]], ["doc_id", *names])
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs.select("doc_id", "text")).mapInArrow(score, ", ".join([f"doc_id {kind}", *[f"{x} double" for x in names]]))


def drop_category(docs: DataFrame, model: Model, category: str, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), model.categories.index(category)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _score(shared.value, batch.column("text").to_pylist())[:, place]
            yield batch.filter(pa.array(p < threshold, pa.bool_()))
        give_back()

    return bounded(docs).mapInArrow(sift, docs.schema)
