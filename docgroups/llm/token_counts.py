"""Tokens of whole documents, attributed to their sections.

A document is encoded once. Its tokens' spans meet the sections' spans in an interval join, two sorted lists
merged by binary search, and a token that crosses a boundary goes where a stated rule says.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docgroups.llm.batches import bounded
from docgroups.llm.packing import encoder

RULES = ("first", "last", "most", "share")


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section: token i covers bytes ``ends[i - 1]`` to ``ends[i]``, section j ``bounds[j]`` to ``bounds[j + 1]``.

    A token that lies in several sections counts, by the rule, for the one with its ``first`` byte, for the
    one with its ``last``, for the one with ``most`` of it (of equals the earlier), or for each by its ``share``.
    Sections follow each other from 0 to the end; empty ones get nothing.
    """
    n = len(bounds) - 1
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends, side="left") - 1
    if rule == "first":
        return np.bincount(first, minlength=n).astype(float)
    if rule == "last":
        return np.bincount(last, minlength=n).astype(float)
    inner = first == last
    counts = np.bincount(first[inner], minlength=n).astype(float)
    for i in np.flatnonzero(~inner).tolist():
        touched = np.arange(first[i], last[i] + 1)
        overlap = np.minimum(bounds[touched + 1], ends[i]) - np.maximum(bounds[touched], starts[i])
        if rule == "share":
            counts[touched] += overlap / overlap.sum()
        else:
            counts[touched[overlap.argmax()]] += 1
    return counts


def line_sections(text: str) -> list[int]:
    """Ends of the lines of a text, in code points; a line holds its line feed, and an empty text is one empty line."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return ends


def count_tokens(docs: DataFrame, path: str, rule: str = "first", sections: Callable[[str], list[int]] = line_sections) -> DataFrame:
    """``(doc_id, section, start, end, n_tokens)``, a row for each section of each row of ``(doc_id, text)``.

    ``sections`` gives the ends of a text's sections in rising order, the last being the text's length.
    ``start`` and ``end`` are code points. A character whose bytes lie in several tokens belongs to them all; a
    section boundary lies between characters, so bytes and characters attribute alike. A null text is an
    empty one. Over a document the counts add up to its tokens, whatever the rule.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule} is none of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                texts = [x or "" for x in part.column("text").to_pylist()]
                row, number, start, end, tokens = [], [], [], [], []
                for i, (text, ids) in enumerate(zip(texts, encode(texts))):
                    ends = np.cumsum(encode.sizes[np.frombuffer(ids, dtype="<u4")])
                    cuts = sections(text)
                    if text.isascii():
                        bounds = np.array([0, *cuts])
                    else:
                        raw = [len(text[a:b].encode()) for a, b in zip([0, *cuts], cuts)]
                        bounds = np.concatenate([[0], np.cumsum(raw)])
                    row += [i] * len(cuts)
                    number += range(len(cuts))
                    start += [0, *cuts[:-1]]
                    end += cuts
                    tokens.append(attribute(ends, bounds, rule))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(end, pa.int64()), pa.array(np.concatenate(tokens) if tokens else [], pa.float64()),
                ], ["doc_id", "section", "start", "end", "n_tokens"])
        encode.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, section int, start long, end long, n_tokens double")
