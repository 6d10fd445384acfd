import pytest
from pyspark.sql import functions as F

from docgroups.functions import text


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t"))).first()[0]


def test_word_tokens(spark):
    assert one(spark, "Don't a bÉ_9 x-ray, 42!", text.word_tokens) == ["don", "bé_9", "ray", "42"]
    assert one(spark, None, text.word_tokens) == []


def test_whitespace_tokens(spark):
    assert one(spark, "  Good.\tgood\n x y ", text.whitespace_tokens) == ["Good.", "good", "x", "y"]
    assert one(spark, "", text.whitespace_tokens) == []


@pytest.mark.parametrize("low,high,expected", [
    (1, 1, ["aa", "bb", "cc"]),
    (1, 2, ["aa", "bb", "cc", "aa bb", "bb cc"]),
    (2, 3, ["aa bb", "bb cc", "aa bb cc"]),
    (4, 4, []),
])
def test_ngrams(spark, low, high, expected):
    assert one(spark, "aa bb cc", lambda t: text.ngrams(text.word_tokens(t), low, high)) == expected


def test_bad_ngram_range():
    with pytest.raises(ValueError):
        text.ngrams(F.array(), 2, 1)


def test_char_ngrams(spark):
    assert one(spark, "ab", lambda t: text.char_ngrams(text.letters(t))) == ["<ab", "ab>", "<ab>"]
    assert one(spark, "äbc", lambda t: text.char_ngrams(text.letters(t), 3, 3)) == ["<äb", "äbc", "bc>"]


POST = "From: a\nSubject: b\n\n>old\nJoe wrote:\nbody\n| bar\nmore\n--\nJoe"


def test_clean_post(spark):
    assert one(spark, POST, text.strip_header) == POST.split("\n\n", 1)[1]
    assert one(spark, POST, text.clean_post) == "body\nmore"
    assert one(spark, "no blank line", text.strip_header) == ""
    assert one(spark, "From: a\n\n> all quoted", text.clean_post) == ""
    assert one(spark, None, text.clean_post) == ""


@pytest.mark.parametrize("body,expected", [
    ("a\nb\n---\nsig", "a\nb"),
    ("a\nb", "a\nb"),
    ("--\nsig", "--\nsig"),
    ("\n\na\n\nb\n\n", "a"),
    ("a\n - -\nb", "a\n - -\nb"),
])
def test_strip_footer(spark, body, expected):
    assert one(spark, body, text.strip_footer) == expected
