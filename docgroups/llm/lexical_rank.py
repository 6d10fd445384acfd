"""Ranked lexical search: dense tiles of item weights times tiles of document impacts, exact in float64.

The terms of all items make a small vocabulary. One pass over the documents keeps, of each, its number of terms and the
counts of the vocabulary's terms; its totals give the weights. A second pass, over these counts alone, multiplies: a tile of items with the
columns their terms need, times a tile of documents. All numbers are integers, and a tile ends before its sums can reach 2**53, so the
products of the BLAS are exact and add up as 64-bit integers.

A term is a maximal run of ASCII letters, digits and non-ASCII characters; A-Z are lower-cased. In a document
with n terms of which tf are the term at hand, with N documents that have a term, L terms in all of them and df that hold the term::

    w      = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    m      = 50 + (50 n N) div L
    impact = (10**9 tf) div (1000 tf + 20 m)

A document's score is the sum of ``w * impact`` over an item's distinct terms.

Odd rows: a null or empty text has no term, counts for no statistic and is never ranked. Rows of ``items`` with one
``item_id`` are one item with the terms of all of them; an item without a known term has no rows. Repeated rows of documents are documents
of their own. A null ``doc_id`` comes after all others of its score. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgroups.llm.batches import bounded
from docgroups.session import cut, row_bytes

ITEM_BYTES = 16 << 20  # terms of the items that are ranked at once; more items go in blocks
ITEM_TILE, TERM_TILE, DOC_TILE = 64, 2048, 512
SLICES = 64  # an item's candidates, k of each task, are first ranked within so many slices
EXACT = 1 << 53
MOST_IMPACT = 10**6  # 10**9 tf / (1000 tf + 20 m) is below it
_TERM = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_FOLD = bytes(c if c in _TERM else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """All terms of a text in UTF-8. Bytes from 128 on belong to non-ASCII characters, all of which are part of a term."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, distinct."""

    def split(batches):
        for batch in batches:
            ids, out = batch["item_id"], ([], [])
            for at, text in enumerate(batch["text"]):
                found = {t.decode("utf-8", "surrogatepass") for t in terms(text.as_py())}
                out[0].extend([at] * len(found))
                out[1].extend(found)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.string())], names=["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return bounded(items.select("item_id", "text")).mapInArrow(split, f"item_id {kind}, term string").distinct()


def term_counts(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``(doc_id, n, ids, tfs)`` for each document with a term: all its terms, and the counts of those in the vocabulary."""
    places = {t.encode("utf-8", "surrogatepass"): i for i, t in enumerate(vocabulary)}

    def count(batches):
        for batch in batches:
            kept, n, ids, tfs, ends = [], [], [], [], [0]
            for at, text in enumerate(batch["text"]):
                found = terms(text.as_py())
                if not found:
                    continue
                known = [p for p in map(places.get, found) if p is not None]
                unique, times = np.unique(np.array(known, dtype=np.int32), return_counts=True)
                kept.append(at)
                n.append(len(found))
                ids.append(unique)
                tfs.append(times.astype(np.int64))
                ends.append(ends[-1] + unique.size)
            if kept:
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].take(pa.array(kept)).cast(pa.int64()), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(tfs), pa.int64())),
                ], names=["doc_id", "n", "ids", "tfs"])

    return bounded(docs.select("doc_id", "text")).mapInArrow(count, "doc_id long, n long, ids array<int>, tfs array<long>")


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000.0 * np.log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0))).astype(np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """Impacts of counts ``tf`` in documents of ``n`` terms; the product before the division may pass 64 bits."""
    m = np.array([50 + 50 * int(v) * n_docs // all_terms for v in n], dtype=np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def item_tiles(item: np.ndarray, term: np.ndarray, w: np.ndarray, n_items: int) -> list[tuple[int, list]]:
    """``(first item, [(columns, matrix of columns x items), ...])``: only the columns that a tile's items use.

    A block of columns ends at TERM_TILE columns, or before its weights could make a sum of 2**53.
    """
    tiles = []
    for first in range(0, n_items, ITEM_TILE):
        width = min(ITEM_TILE, n_items - first)
        own = (item >= first) & (item < first + width) & (w[term] > 0)
        columns = np.unique(term[own])
        blocks, begin, total = [], 0, 0
        for at, weight in enumerate(w[columns]):
            if at - begin == TERM_TILE or (total + int(weight)) * MOST_IMPACT >= EXACT:
                blocks.append(columns[begin:at])
                begin, total = at, 0
            total += int(weight)
        blocks.append(columns[begin:])
        dense = []
        for block in filter(len, blocks):
            here = np.isin(term[own], block)
            matrix = np.zeros((block.size, width))
            matrix[np.searchsorted(block, term[own][here]), item[own][here] - first] = w[term[own][here]]
            dense.append((block, matrix))
        tiles.append((first, dense))
    return tiles


class Best:
    """The k best documents of each item seen so far; equal scores by ascending id, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, dtype=np.int64)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, first: int, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """``scores`` of documents x items from item ``first`` on."""
        least = self.least[first:first + scores.shape[1]]
        if scores.shape[0] > self.k:
            # At least k documents of this tile reach the kth score, and all that tie with it stay.
            least = np.maximum(least, np.partition(scores, -self.k, axis=0)[-self.k])
        row, column = np.nonzero(scores >= least)
        if not row.size:
            return
        self.item = np.concatenate([self.item, column + first])
        self.score = np.concatenate([self.score, scores[row, column]])
        self.doc = np.concatenate([self.doc, doc[row]])
        self.null = np.concatenate([self.null, null[row]])
        if self.item.size > 4 * self.k * self.least.size + 100_000:
            self.trim()

    def trim(self) -> None:
        order = np.lexsort((self.doc, self.null, -self.score, self.item))
        item = self.item[order]
        place = np.arange(item.size) - np.searchsorted(item, item)
        order = order[place < self.k]
        self.item, self.score, self.doc, self.null = (a[order] for a in (self.item, self.score, self.doc, self.null))
        last = place[place < self.k] == self.k - 1
        self.least[self.item[last]] = np.maximum(self.least[self.item[last]], self.score[last])


def _tile_best(counts: DataFrame, pairs: tuple, n_items: int, df: np.ndarray, n_docs: int, all_terms: int, k: int) -> DataFrame:
    """``(item, doc_id, score)``: the k best of each item and task."""
    item, term = pairs
    w = weights(df, n_docs)

    def multiply(batches):
        tiles, best = item_tiles(item, term, w, n_items), Best(n_items, k)
        for batch in batches:
            for at in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(at, DOC_TILE)
                doc = part["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
                null = part["doc_id"].is_null().to_numpy(zero_copy_only=False)
                ids = part["ids"].flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), np.diff(part["ids"].offsets.to_numpy()))
                tf, n = part["tfs"].flatten().to_numpy(), part["n"].to_numpy()
                impact = impacts(tf, n[row], n_docs, all_terms) if ids.size else tf
                place = np.full(df.size, -1, dtype=np.int64)
                for first, blocks in tiles:
                    scores = np.zeros((part.num_rows, min(ITEM_TILE, n_items - first)), dtype=np.int64)
                    for columns, matrix in blocks:
                        place[columns] = np.arange(columns.size)
                        own = np.flatnonzero(place[ids] >= 0)
                        if own.size:
                            held = np.zeros((part.num_rows, columns.size))
                            held[row[own], place[ids[own]]] = impact[own]
                            scores += (held @ matrix).astype(np.int64)
                        place[columns] = -1
                    best.add(first, scores, doc, null)
        best.trim()
        yield pa.RecordBatch.from_arrays([
            pa.array(best.item.astype(np.int32)), pa.array(best.doc, mask=best.null), pa.array(best.score),
        ], names=["item", "doc_id", "score"])

    return bounded(counts).mapInArrow(multiply, "item int, doc_id long, score long")


def _rank_block(docs: DataFrame, pairs: list, kind: str, k: int) -> DataFrame:
    """Ranks all documents for the items of one block, given as ``(item_id, term)`` rows; ``kind`` is the type of an item's id."""
    spark = docs.sparkSession
    item_ids = list(dict.fromkeys(r["item_id"] for r in pairs))
    vocabulary = sorted({r["term"] for r in pairs})
    item_at, term_at = {v: i for i, v in enumerate(item_ids)}, {t: i for i, t in enumerate(vocabulary)}
    item = np.array([item_at[r["item_id"]] for r in pairs], dtype=np.int64)
    term = np.array([term_at[r["term"]] for r in pairs], dtype=np.int64)
    counts = cut(term_counts(docs, vocabulary))
    n_docs, all_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in counts.select(F.explode("ids").alias("id")).groupBy("id").count().collect():
        df[r["id"]] = r["count"]
    found = _tile_best(counts, (item, term), len(item_ids), df, n_docs, max(all_terms, 1), k)
    # First within slices of an item's candidates, then among those that are left.
    found = found.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    near = found.withColumn("place", F.row_number().over(Window.partitionBy("item", "slice").orderBy(*order))).where(F.col("place") <= k)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(item_ids)), f"item int, item_id {kind}")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 50, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each of ``items`` (item_id, text) its k best rows of ``docs`` (doc_id, text) with a score above 0.

    Items are ranked in blocks whose terms stay below ``item_bytes``; each block reads the documents once.
    """
    wanted = cut(item_terms(items))
    kind = items.schema["item_id"].dataType.simpleString()
    blocks = max(1, math.ceil(row_bytes(wanted) / item_bytes))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for b in range(blocks):
        rows = wanted.where(block == b).collect()
        if rows:
            ranked = _rank_block(docs, rows, kind, k)
            out = ranked if blocks == 1 else out.unionByName(ranked)
    return out
