"""Encoding and decoding with a merge-type SentencePiece model.

The encoding of a text is the one sequence of pieces in which every adjacent pair is what merging the two
pieces' characters anew gives. It is found by backtracking: at each place the longest piece that an
Aho-Corasick automaton matches, or the next shorter one, if it goes with the piece before; places from which
nothing leads to the end are marked in a bit field and never tried again.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from docgroups.llm.batches import bounded
from docgroups.llm.once import once

BLANK = "▁"
SEGMENT = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
CACHE_ENTRIES = 500_000
CACHED_LENGTH = 48


class Known(dict):
    """What ``make`` gives for a text, kept if the text is short."""

    def __init__(self, make: Callable[[str], str]):
        super().__init__()
        self.make = make

    def __missing__(self, text: str) -> str:
        found = self.make(text)
        if len(text) <= CACHED_LENGTH:
            self[text] = found
        return found


class PieceBpe:
    """A model file of type BPE with byte fallback, blanks escaped, a blank put before the text, and no normalisation."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.text_of: list[str | None] = []  # of a piece; None: a byte or control piece
        self.byte_of: dict[int, int] = {}
        self.unknown = model.unk_id()
        self.automaton = ahocorasick.Automaton()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            plain = not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
            self.text_of.append(piece if plain else None)
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.byte_of[i] = int(piece[1:-1], 16)
            elif plain:
                self.id[piece], self.score[piece] = i, model.get_score(i)
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        if any(BLANK in x.lstrip(BLANK) for x in self.id):
            raise ValueError("a piece holds a blank after another character: texts can't be cut at blanks")
        self.shorter: dict[str, str | None] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        # Two characters that stand together in no piece are never merged: texts may be cut between them.
        self.adjacent = {x[i:i + 2] for x in self.id for i in range(len(x) - 1)}
        self.words = Known(lambda word: self.segment(BLANK + word))
        self.parts = Known(lambda part: ",".join(map(str, self.ids(self.backtrack(part)))))
        codecs.register_error("each_byte", lambda e: ("\ufffd", e.start + 1))
        shown = [(x or "").replace(BLANK, " ") for x in self.text_of]
        shown[self.unknown] = " ⁇ "
        for i, b in self.byte_of.items():
            shown[i] = bytes([b]).decode(errors="surrogateescape")
        self.shown = {str(i): x for i, x in enumerate(shown)}

    def merge(self, text: str) -> list[str]:
        """Pieces by merging: the pair with the best score, the leftmost of equals, until none is a piece."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > CACHE_ENTRIES:
                self.fits.clear()
            found = self.fits[key] = self.merge(left + right) == [left, right]
        return found

    def next_shorter(self, piece: str) -> str | None:
        """The longest piece that begins this one, at least its first character."""
        if piece not in self.shorter:
            found = None
            for n in range(len(piece) - 1, 0, -1):
                if n == 1 or piece[:n] in self.id:
                    found = piece[:n]
                    break
            self.shorter[piece] = found
        return self.shorter[piece]

    def backtrack(self, text: str) -> list[str]:
        """The pieces of a text; a character that is no piece stands for itself."""
        n = len(text)
        longest = [1] * n
        for end, size in self.automaton.iter(text):
            if size > longest[end - size + 1]:
                longest[end - size + 1] = size
        open_places = (1 << (n + 1)) - 1 if n < 4096 else bytearray(b"\1") * (n + 1)
        bits = isinstance(open_places, int)
        out: list[str] = []
        at, piece = 0, text[:longest[0]]
        while True:
            end = at + len(piece)
            is_open = (open_places >> end) & 1 if bits else open_places[end]
            if is_open and (not out or self.compatible(out[-1], piece)):
                out.append(piece)
                at = end
                if at == n:
                    return out
                piece = text[at:at + longest[at]]
                continue
            shorter = self.next_shorter(piece)
            while shorter is None:
                if bits:
                    open_places &= ~(1 << at)
                else:
                    open_places[at] = 0
                piece = out.pop()
                at -= len(piece)
                shorter = self.next_shorter(piece)
            piece = shorter

    def ids(self, pieces: list[str]) -> list[int]:
        """Ids of pieces; an unknown character gives those of its bytes."""
        out = []
        for piece in pieces:
            if piece in self.id:
                out.append(self.id[piece])
            elif self.byte_id:
                out += [self.byte_id[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        return out

    def segment(self, text: str) -> str:
        """The ids in decimal, with commas between, of what lies between two places where a blank begins."""
        cuts = [i for i in range(1, len(text)) if text[i - 1:i + 1] not in self.adjacent]
        return ",".join([self.parts[text[a:b]] for a, b in zip([0, *cuts], [*cuts, len(text)])])

    def encode(self, text: str) -> tuple[int, str]:
        """Number of ids and the ids of a whole text in decimal, with commas between."""
        if not text:
            return 0, ""
        for cache in (self.words, self.parts):
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
        if BLANK in text or "  " in text or text[0] == " " or text[-1] == " ":
            ids = ",".join(map(self.segment, SEGMENT.findall(BLANK + text.replace(" ", BLANK))))
        else:
            ids = ",".join(map(self.words.__getitem__, text.split(" ")))
        return ids.count(",") + 1, ids

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes in a row are read as UTF-8, blanks restored, and the one before the text taken off.

        Bytes that are no UTF-8 give U+FFFD each; control pieces give nothing, the unknown piece its sign.
        """
        return self.read(",".join(map(str, ids)))

    def read(self, ids: str) -> str:
        """Text of ids in decimal with commas between."""
        if not ids:
            return ""
        numbers = ids.split(",")
        text = "".join(map(self.shown.__getitem__, numbers))
        if text.startswith(" "):
            first = int(next(i for i in numbers if self.shown[i]))
            if (self.text_of[first] or "").startswith(BLANK):
                text = text[1:]
        # Bytes of 128 and more stand for themselves as lone surrogates until here.
        return text.encode(errors="surrogateescape").decode(errors="each_byte")


def load(path: str) -> PieceBpe:
    """One for each Python worker, so what it has learned serves later tasks too."""
    return once(f"piece model {path}", lambda: PieceBpe(path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)`` of ``(doc_id, text)``, ids in decimal with commas between; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                ids = [model.encode(x or "")[1] for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.string())], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, ids string")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                texts = [model.read(x or "") for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encode, decode those ids, and keep digests only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                counts, ids_sha, text_sha = [], [], []
                for text in part.column("text").to_pylist():
                    n, ids = model.encode(text or "")
                    decoded = model.read(ids)
                    counts.append(n)
                    ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
