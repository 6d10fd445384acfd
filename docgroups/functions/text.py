"""Column expressions over text: cleaning, tokens, n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns the results depend on.
WORD = r"[\p{L}\p{N}_]{2,}"
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+"
QUOTE_LINE = r"(writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\||^>)"
FOOTER_LINE = r"^\s*-*\s*$"


def known_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def word_tokens(text: Column) -> Column:
    """Lowercased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(known_text(text)), F.lit(WORD), F.lit(0))


def whitespace_tokens(text: Column) -> Column:
    """Runs between white space, case and punctuation kept."""
    return F.filter(F.split(known_text(text), SPACE), lambda t: t != "")


def _runs(parts: Column, n: int, glue: str) -> Column:
    """Runs of ``n`` neighbours, built by zipping the list with itself shifted by one: linear in its length."""
    runs, count = parts, F.size(parts)
    for shift in range(1, n):
        length = F.greatest(count - shift, F.lit(0))
        runs = F.zip_with(
            F.slice(runs, F.lit(1), length), F.slice(parts, F.lit(shift + 1), length),
            lambda a, b: F.concat(a, F.lit(glue), b),
        )
    return runs


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All n-grams with ``low <= n <= high``, words joined by one space.

    Pass a column of an earlier select: an expression would be evaluated once per use.
    """
    if not 1 <= low <= high:
        raise ValueError(f"bad n-gram range ({low}, {high})")
    return F.concat(*[_runs(tokens, n, " ") for n in range(low, high + 1)])


def letters(word: Column) -> Column:
    """The characters of ``<word>``, the marks showing where the word starts and ends."""
    return F.split(F.concat(F.lit("<"), word, F.lit(">")), "")


def char_ngrams(letters_: Column, low: int = 3, high: int = 6) -> Column:
    """Character n-grams over a column of ``letters``."""
    return F.concat(*[_runs(letters_, n, "") for n in range(low, high + 1)])


def strip_header(text: Column) -> Column:
    """What follows the first blank line; nothing when there is no blank line."""
    at = F.instr(text, "\n\n")
    return F.when(at > 0, F.substring(text, at + 2, F.length(text))).otherwise("")


def strip_footer(text: Column) -> Column:
    """Drop everything from the last blank or dashes-only line on, unless that is the first line."""
    lines = F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), "\n", -1)
    marks = F.transform(lines, lambda line, i: F.when(line.rlike(FOOTER_LINE), i))
    last = F.coalesce(F.array_max(marks), F.lit(0))
    return F.when(last > 0, F.array_join(F.slice(lines, F.lit(1), last), "\n")).otherwise(text)


def strip_quotes(text: Column) -> Column:
    """Drop lines that quote or introduce another post."""
    lines = F.split(text, "\n", -1)
    return F.array_join(F.filter(lines, lambda line: ~line.rlike(QUOTE_LINE)), "\n")


def clean_post(text: Column) -> Column:
    return strip_quotes(strip_footer(strip_header(known_text(text))))
