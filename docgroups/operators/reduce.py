"""Fewer dimensions: truncated SVD for weighted terms, PCA for dense vectors.

The SVD is randomised subspace iteration (Halko, Martinsson and Tropp, 2011) on the term side. When
the terms x sketch basis is below a bound, each pass is one scan that multiplies by the matrix and its
transpose together. Beyond the bound the basis stays a table and a pass meets blocks of
terms, then blocks of documents, in tasks that sum before they shuffle. The bound chooses the plan
only: start, orthonormalisation, stopping rule and signs are the same, so results differ by rounding alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgroups.functions.arrays import lists, matrix, vector_sum
from docgroups.operators.tfidf import packed_rows, ranked_terms
from docgroups.session import cut, scratch_path

OVERSAMPLE = 10
PASSES = 6  # at least; more until the singular values settle
MAX_PASSES = 20
TOLERANCE = 1e-3
BASIS_BYTES = 128 * 1024 * 1024
DOCS_AT_ONCE = 64
TERMS_AT_ONCE = 1024
FAN_IN = 32
BLOCK_BYTES = 64 * 1024 * 1024  # rows of one block of keys
BLOCK_ENTRIES = 4_000_000
ENTRIES_AT_ONCE = 1 << 15


def allowed_sizes(sizes, n_rows: int, n_columns: int) -> list[int]:
    """Sizes that fit the data: at most min(rows, columns) - 1."""
    return [s for s in sizes if s <= min(n_rows, n_columns) - 1]


def _sparse_chunks(batch: pa.RecordBatch):
    """Runs of documents as (first row, terms used, dense documents x used terms)."""
    sizes = np.diff(batch["idx"].offsets.to_numpy())
    idx = batch["idx"].flatten().to_numpy()
    val = batch["val"].flatten().to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for at in range(0, len(sizes), DOCS_AT_ONCE):
        stop = min(at + DOCS_AT_ONCE, len(sizes))
        part = slice(ends[at], ends[stop])
        used, column = np.unique(idx[part], return_inverse=True)
        dense = np.zeros((stop - at, used.size))
        dense[np.repeat(np.arange(stop - at), sizes[at:stop]), column] = val[part]
        yield at, used, dense


def _sum_parts(parts: DataFrame, n_parts: int) -> DataFrame:
    """Add the ``(part, term_id, vec)`` rows of all tasks, at most ``FAN_IN`` tasks and
    ``TERMS_AT_ONCE`` terms to a group, in as many levels as that takes."""
    def add(table: pa.Table) -> pa.Table:
        ids, at = np.unique(table["term_id"].to_numpy(), return_inverse=True)
        rows = matrix(table["vec"])
        total = np.zeros((len(ids), rows.shape[1]))
        np.add.at(total, at, rows)
        part = np.full(len(ids), table["part"][0].as_py(), dtype=np.int32)
        return pa.table({"part": part, "term_id": ids, "vec": lists(total)})

    while n_parts > 1:
        n_parts = -(-n_parts // FAN_IN)
        merged = parts.withColumn("part", F.pmod("part", F.lit(n_parts)))
        block = F.floor(F.col("term_id") / TERMS_AT_ONCE)
        parts = merged.groupBy("part", block).applyInArrow(
            lambda key, table: add(table), "part int, term_id long, vec array<double>"
        )
    return parts


def _scan_terms(packed: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'A times the basis in one scan; each task sends only the terms it saw."""
    def product(batches):
        total, seen = np.zeros_like(basis), np.zeros(len(basis), dtype=bool)
        for batch in batches:
            if batch.num_rows:
                for _, used, dense in _sparse_chunks(batch):
                    total[used] += dense.T @ (dense @ basis[used])
                    seen[used] = True
        at, part = np.flatnonzero(seen), TaskContext.get().partitionId()
        for start in range(0, at.size, TERMS_AT_ONCE):
            ids = at[start:start + TERMS_AT_ONCE]
            yield pa.RecordBatch.from_pydict(
                {"part": np.full(ids.size, part, dtype=np.int32), "term_id": ids, "vec": lists(total[ids])}
            )

    parts = packed.select("idx", "val").mapInArrow(product, "part int, term_id long, vec array<double>")
    summed = _sum_parts(parts, packed.rdd.getNumPartitions()).select("term_id", "vec").toArrow()
    out = np.zeros_like(basis)
    if summed.num_rows:
        out[summed["term_id"].to_numpy()] = matrix(summed["vec"])
    return out


def _scan_documents(packed: DataFrame, basis: np.ndarray) -> DataFrame:
    def project(batches):
        for batch in batches:
            if batch.num_rows:
                rows = np.concatenate([dense @ basis[used] for _, used, dense in _sparse_chunks(batch)])
                yield pa.RecordBatch.from_pydict({"id": batch["id"], "vec": lists(rows)})

    return packed.mapInArrow(project, "id long, vec array<double>")


def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Summed outer products: width x width numbers per task."""
    def outer(batches):
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch["vec"])
                total += x.T @ x
        yield pa.RecordBatch.from_pydict({"g": lists(total.reshape(1, -1))})

    parts = vectors.select("vec").mapInArrow(outer, "g array<double>")
    return np.array(parts.agg(vector_sum(F.col("g"))).first()[0]).reshape(width, width)


def _times(vectors: DataFrame, key: str, small: np.ndarray) -> DataFrame:
    def turn(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict({key: batch[key], "vec": lists(matrix(batch["vec"]) @ small)})

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(key, "vec").mapInArrow(turn, f"{key} {kind}, vec array<double>")


def _whiten(gram: np.ndarray) -> np.ndarray:
    """Square matrix that makes vectors with this Gram matrix orthonormal."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > values.max() * 1e-13
    scaled = np.where(keep, 1.0 / np.sqrt(np.where(keep, values, 1.0)), 0.0)
    return vectors * scaled


def _start(vocabulary: DataFrame, width: int, seed: int) -> DataFrame:
    """``vocabulary`` with a first basis of signs by the hash of term and column."""
    signs = F.transform(
        F.sequence(F.lit(1), F.lit(width)),
        lambda i: F.when(F.xxhash64("term", i, F.lit(seed)) % 2 == 0, 1.0).otherwise(-1.0),
    )
    return vocabulary.withColumn("vec", signs)


class _Settled:
    """Whether the leading singular values, read off the Gram matrix of each pass, have stopped to move."""

    def __init__(self, n_components: int):
        self.n, self.passes, self.before = n_components, 0, None

    def __call__(self, gram: np.ndarray) -> bool:
        # The pass multiplied by the squared matrix, and the Gram matrix squares once more.
        now = np.sqrt(np.sqrt(np.maximum(np.linalg.eigvalsh(gram)[::-1][:self.n], 0.0)))
        moved = np.inf if self.before is None else (np.abs(now - self.before) / max(now[0], 1e-300)).max()
        self.passes, self.before = self.passes + 1, now
        return self.passes >= PASSES and (moved <= TOLERANCE or self.passes >= MAX_PASSES)


def _scanned_basis(packed: DataFrame, ranked: DataFrame, width: int, n_components: int, seed: int) -> np.ndarray:
    """Subspace iteration with the basis on the driver and in every task, one scan a pass."""
    first = _start(ranked, width, seed).select("term_id", "vec").toArrow()
    basis = np.zeros((first.num_rows, width))
    basis[first["term_id"].to_numpy()] = matrix(first["vec"])
    settled, done = _Settled(n_components), False
    while not done:
        basis = _scan_terms(packed, basis)
        gram = basis.T @ basis
        done = settled(gram)
        basis = basis @ _whiten(gram)
        basis = basis @ _whiten(basis.T @ basis)
    return basis


def _joined_rows(weights: DataFrame, vocabulary: DataFrame, width: int, n_components: int, seed: int, by_term: int, by_document: int) -> DataFrame:
    """``(id, vec)``: documents times the basis of a subspace iteration whose basis is a table ``(term, vec)`` times a small matrix.

    What makes the basis orthonormal is applied to the documents' rows. Of the bases of all passes, two exist at a time.
    """
    documents = scratch_path(weights.sparkSession, "rows")
    places = [scratch_path(weights.sparkSession, "basis") for _ in range(2)]
    basis, turn = _start(vocabulary.select("term"), width, seed).select("term", "vec"), np.eye(width)
    settled, done = _Settled(n_components), False
    while not done:
        rows = cut(_times(_joined_product(weights, basis, "term", "doc_id", by_term), "doc_id", turn), documents)
        basis = cut(_joined_product(weights, rows, "doc_id", "term", by_document), places[settled.passes % 2])
        gram = _gram(basis, width)
        done = settled(gram)
        turn = _whiten(gram)
        turn = turn @ _whiten(_gram(_times(basis, "term", turn), width))
    rows = _times(_joined_product(weights, basis, "term", "doc_id", by_term), "doc_id", turn)
    return rows.select(F.col("doc_id").alias("id"), "vec")


def _signs(rows: DataFrame, turn: np.ndarray) -> np.ndarray:
    """Per component the sign that makes the sum of the cubed document scores positive: long tails point up."""
    def cubes(batches):
        total = np.zeros(turn.shape[1])
        for batch in batches:
            if batch.num_rows:
                total += ((matrix(batch["vec"]) @ turn) ** 3).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"c": lists(total.reshape(1, -1))})

    parts = rows.select("vec").mapInArrow(cubes, "c array<double>")
    return np.where(np.array(parts.agg(vector_sum(F.col("c"))).first()[0]) < 0, -1.0, 1.0)


def _rows_by_code(codes: np.ndarray, held, n: int, width: int) -> np.ndarray:
    """Sums by code of the rows that ``held`` gives for runs of entries in the order of their codes."""
    order, out = np.argsort(codes, kind="stable"), np.zeros((n, width))
    for at in range(0, len(order), ENTRIES_AT_ONCE):
        part = order[at:at + ENTRIES_AT_ONCE]
        own = codes[part]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        out[own[first]] += np.add.reduceat(held(part), first, axis=0)
    return out


def _joined_product(weights: DataFrame, table: DataFrame, key: str, other: str, blocks: int) -> DataFrame:
    """``(other, vec)``: sums of ``tfidf`` times the row ``vec`` of its ``key``, summed inside blocks of keys before they are shuffled."""
    width = len(table.select("vec").first()[0])
    kind = f"{other} {weights.schema[other].dataType.simpleString()}, vec array<double>"
    empty = np.zeros((0, width))

    def coded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
        column = column.combine_chunks().dictionary_encode(null_encoding="encode")
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return column.indices.to_numpy(), column.dictionary

    def product(a: pa.Table, b: pa.Table) -> pa.Table:
        at = pc.index_in(a[key], value_set=b[key].combine_chunks(), skip_nulls=True)
        a, at = a.filter(pc.is_valid(at)), at.drop_null().to_numpy()
        if not a.num_rows:
            return pa.table({other: a[other], "vec": lists(empty)})
        rows, w = matrix(b["vec"]), a["tfidf"].to_numpy()
        codes, names = coded(a[other])
        return pa.table({other: names, "vec": lists(_rows_by_code(codes, lambda part: rows[at[part]] * w[part, None], len(names), width))})

    def add(table: pa.Table) -> pa.Table:
        rows = matrix(table["vec"])
        codes, names = coded(table[other])
        return pa.table({other: names, "vec": lists(_rows_by_code(codes, lambda part: rows[part], len(names), width))})

    def block(df: DataFrame, by: str) -> DataFrame:
        return df.withColumn("block", F.pmod(F.xxhash64(by), F.lit(blocks)))

    left = block(weights.select(key, other, "tfidf"), key).repartition(blocks, "block").groupBy("block")
    right = block(table.select(key, "vec"), key).repartition(blocks, "block").groupBy("block")
    partial = left.cogroup(right).applyInArrow(product, kind)
    return block(partial, other).groupBy("block").applyInArrow(add, kind)


def _key_blocks(weights: DataFrame, entries: int, keys: int, others: int, width: int) -> int:
    """Blocks of keys whose rows, entries and sums stay bounded."""
    cores = weights.sparkSession.sparkContext.defaultParallelism
    sums = -(-min(entries, others) * 8 * width // BASIS_BYTES)
    by_sums = -(-entries * 8 * width // BASIS_BYTES) if sums > 1 else 1
    return max(cores, -(-keys * 8 * width // BLOCK_BYTES), -(-entries // BLOCK_ENTRIES), by_sums)


def truncated_svd(
    weights: DataFrame,
    vocabulary: DataFrame,
    corpus: DataFrame,
    n_components: int,
    seed: int = 42,
    basis_bytes: int = BASIS_BYTES,
) -> tuple[DataFrame, np.ndarray]:
    """``(id, vec)`` with the rows of U*S for every document, and the singular values.

    Nothing is centred. Documents without a weighted term get the zero vector. Components nest: the
    first s entries are the reduction to s components.
    """
    n_terms, n_docs = vocabulary.count(), corpus.count()
    if n_components > min(n_terms, n_docs):
        raise ValueError(f"{n_components} components do not fit {n_docs} documents x {n_terms} terms")
    width = min(n_components + OVERSAMPLE, n_terms, n_docs)
    if 8 * n_terms * width <= basis_bytes:
        ranked = cut(ranked_terms(vocabulary))
        packed = cut(packed_rows(weights, ranked))
        rows = cut(_scan_documents(packed, _scanned_basis(packed, ranked, width, n_components, seed)))
    else:
        weights = cut(weights.select("doc_id", "term", "tfidf"))
        entries = weights.count()
        by_term = _key_blocks(weights, entries, n_terms, n_docs, width)
        by_document = _key_blocks(weights, entries, n_docs, n_terms, width)
        rows = cut(_joined_rows(weights, vocabulary, width, n_components, seed, by_term, by_document))
    values, vectors = np.linalg.eigh(_gram(rows, width))
    order = np.argsort(values)[::-1][:n_components]
    turn = vectors[:, order]
    turn = turn * _signs(rows, turn)
    reduced = _times(rows, "id", turn)
    zeros = F.array_repeat(F.lit(0.0), n_components)
    every = corpus.select(F.col("doc_id").alias("id")).join(reduced, "id", "left")
    return every.select("id", F.coalesce("vec", zeros).alias("vec")), np.sqrt(np.maximum(values[order], 0.0))


def pca(vectors: DataFrame, n_components: int) -> tuple[DataFrame, np.ndarray]:
    """Centred scores ``(id, vec)`` and the share of variance of each component."""
    rows = vectors.select("id", array_to_vector(F.col("vec").cast("array<double>")).alias("raw"))
    scaler = StandardScaler(withMean=True, withStd=False, inputCol="raw", outputCol="centred").fit(rows)
    centred = scaler.transform(rows).select("id", "centred")
    model = PCA(k=n_components, inputCol="centred", outputCol="scores").fit(centred)
    scores = model.transform(centred).select("id", vector_to_array("scores").alias("vec"))
    return scores, model.explainedVariance.toArray()


def reduce_dimensions(kind: str, n_components: int, seed: int = 42, **data) -> tuple[DataFrame, np.ndarray]:
    """``sparse`` takes ``weights, vocabulary, corpus``; ``dense`` takes ``vectors``."""
    if kind == "sparse":
        return truncated_svd(data["weights"], data["vocabulary"], data["corpus"], n_components, seed)
    if kind == "dense":
        return pca(data["vectors"], n_components)
    raise ValueError(f"unknown kind {kind!r}")


def first_components(vectors: DataFrame, size: int) -> DataFrame:
    return vectors.withColumn("vec", F.slice("vec", 1, size))
