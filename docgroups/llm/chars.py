"""Texts as arrays of code points, cut into words without a loop over words."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np

from docgroups.llm.once import once

# First and last code point of each script's blocks, by the Unicode block list (fixed values).
SCRIPT_RANGES = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
N_SCRIPTS = len(SCRIPT_RANGES) + 1
CHUNK = 400_000


def tables() -> dict[str, np.ndarray]:
    """By code point: lower case, in a word, letter, upper case, digit, blank, script (0: any other)."""
    return once("character_tables", _tables)


def _tables() -> dict[str, np.ndarray]:
    n = sys.maxunicode + 1
    kind = np.array([unicodedata.category(chr(i)) for i in range(n)], dtype="U2")
    major = kind.astype("U1")
    lower = np.arange(n, dtype=np.uint32)
    for i in np.flatnonzero((kind == "Lu") | (kind == "Lt")).tolist():
        other = chr(i).lower()
        if len(other) == 1:
            lower[i] = ord(other)
    script = np.zeros(n, dtype=np.uint8)
    for number, ranges in enumerate(SCRIPT_RANGES.values(), 1):
        for first, last in ranges:
            script[first:last + 1] = number
    return {
        "lower": lower, "letter": major == "L", "word": (major == "L") | (major == "M"),
        "upper": kind == "Lu", "digit": kind == "Nd", "blank": (major == "Z") | (kind == "Cc"), "script": script,
    }


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def chunks(texts: list[str | None], size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, end, code points, offsets)`` for runs of texts of about ``size`` characters.

    Texts follow each other with one line feed between; ``offsets`` holds where each begins, and the end
    of all. A null text is an empty one. A single longer text is one run.
    """
    first = 0
    while first < len(texts):
        end, total, parts, offsets = first, 0, [], []
        while end < len(texts) and (end == first or total + len(texts[end] or "") <= size):
            offsets.append(total)
            parts.append(texts[end] or "")
            total += len(parts[-1]) + 1
            end += 1
        yield first, end, code_points("\n".join(parts) + "\n"), np.array([*offsets, total], dtype=np.int64)
        first = end


def words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words: runs of letters and marks of one script that hold a letter.

    Marks continue the word before them, whatever their script.
    """
    t = tables()
    inside, letter, script = t["word"][points], t["letter"][points], t["script"][points]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (letter[1:] & letter[:-1] & (script[1:] != script[:-1]))
    starts = np.flatnonzero(begins)
    if not len(starts):
        return starts, starts
    after = np.empty(len(points) + 1, dtype=bool)
    after[:-1], after[-1] = ~inside, True
    stops = np.flatnonzero(after)
    ends = stops[np.searchsorted(stops, starts)]
    ends[:-1] = np.minimum(ends[:-1], starts[1:])
    counts = np.concatenate([[0], np.cumsum(letter)])
    real = counts[ends] > counts[starts]
    return starts[real], ends[real]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a xor-shift and multiply finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers() -> np.ndarray:
    return once("powers", _powers)


def _powers() -> np.ndarray:
    out = [1]
    for _ in range(4095):
        out.append(out[-1] * 0x9E6C63D0876A9A63 % 2**64)
    return np.array(out, dtype=np.uint64)


def run_hashes(terms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``[start, end)`` of ``terms``, 64-bit values that are spread already.

    Runs are in order and don't overlap.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    size = ends - starts
    owner = np.repeat(np.arange(len(starts)), size)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    weighed = terms[starts[owner] + place] * powers()[place & 4095]
    sums = np.add.reduceat(weighed, np.cumsum(size) - size)
    return mix(sums ^ (size.astype(np.uint64) << np.uint64(48)))
