"""Text features."""

from __future__ import annotations

from pyspark.sql import functions as F

from docgroups.functions import text
from docgroups.operators import tfidf, wordvec
from docgroups.registry.common import r6, texts
from docgroups.session import cut

WORD = r"[\p{L}\p{N}_]{2,}"
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]+"

TOKENS = f"""docs AS (SELECT doc_id, coalesce(text, '') AS text, lang FROM documents),
lists AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS ts FROM docs),
tokens AS (SELECT doc_id, unnest(ts) AS term FROM lists)"""
PAIRS = TOKENS + """,
placed AS (SELECT doc_id, unnest(ts) AS term, generate_subscripts(ts, 1) AS pos FROM lists),
pairs AS (SELECT doc_id, term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM placed)"""
COUNTS = TOKENS + """,
tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
n AS (SELECT count(*) AS n FROM docs),
freq AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS total FROM tf GROUP BY term)"""
VOCABULARY = COUNTS + """,
vocab AS (SELECT term, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM freq, n WHERE df >= 5 AND df <= 0.5 * n)"""
WEIGHTS = VOCABULARY + """,
raw AS (SELECT doc_id, term, tf, df, (1.0 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term)),
tfidf AS (SELECT doc_id, term, tf, df, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM raw)"""
VARIANTS = COUNTS + """,
settings(variant, low, high, sub) AS (VALUES ('default', 1.0, 1.0, 0), ('min_df5', 5.0, 1.0, 0),
  ('min_df5_sublinear', 5.0, 1.0, 1), ('min_df5_maxdf05_sublinear', 5.0, 0.5, 1)),
vv AS (SELECT variant, sub, term, df FROM freq, n, settings WHERE df >= low AND df <= high * n)"""


def word_tokens(spark, d):
    frequencies, _ = _frequencies(spark, d)
    return frequencies.select("term", F.col("total").alias("n_tokens"), F.col("df").alias("n_docs"))


def whitespace_tokens(spark, d):
    words = texts(spark, d).select(F.explode(text.whitespace_tokens(F.col("text"))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("n"))


def ngrams(spark, d):
    grams = tfidf.term_totals(texts(spark, d), (1, 2))
    return grams.select(F.col("term").alias("gram"), F.col("total").alias("n"))


def _frequencies(spark, d):
    corpus = texts(spark, d)
    return tfidf.document_frequencies(tfidf.term_counts(corpus)), corpus.count()


def document_frequency_bounds(spark, d):
    return tfidf.keep_terms(*_frequencies(spark, d), 5, 0.5).select("term", "df")


def max_features(spark, d):
    return tfidf.keep_terms(*_frequencies(spark, d), 2, 0.9, 1000).select("term", "df", "total")


def term_frequency(spark, d):
    counts = tfidf.term_counts(texts(spark, d))
    return counts.select("doc_id", "term", "tf", r6(tfidf.tf_weight(F.col("tf"), True)).alias("sublinear"))


def idf(spark, d):
    frequencies, n = _frequencies(spark, d)
    return frequencies.select("term", "df", r6(tfidf.smooth_idf(F.col("df"), n)).alias("idf"))


def tfidf_matrix(spark, d):
    weights, _ = tfidf.build_tfidf(texts(spark, d))
    return weights.select("doc_id", "term", "tf", "df", r6("tfidf").alias("tfidf"))


def tfidf_bigrams(spark, d):
    weights, _ = tfidf.build_tfidf(texts(spark, d), min_df=3, max_df=0.8, sublinear_tf=False, max_features=5000, ngram_range=(1, 2))
    return weights.select("doc_id", "term", r6("tfidf").alias("tfidf"))


def vocabulary(spark, d):
    corpus = texts(spark, d)
    counts = tfidf.term_counts(corpus)
    terms = tfidf.ranked_terms(tfidf.fit_vocabulary(counts, corpus.count()))
    return terms.select("term", "term_id", "df", r6("idf").alias("idf"))


def variant_sizes(spark, d):
    rows = tfidf.variant_vocabularies(*_frequencies(spark, d))
    return rows.groupBy("variant").agg(F.count("*").alias("vocabulary"))


def variant_grid(spark, d):
    """All four matrices from one count of the tokens."""
    corpus = texts(spark, d)
    counts = cut(tfidf.term_counts(corpus))
    n = corpus.count()
    weights = tfidf.variant_weights(counts, cut(tfidf.variant_vocabularies(tfidf.document_frequencies(counts), n)), n)
    return weights.groupBy("variant", "term").agg(
        F.count("*").alias("n_docs"), r6(F.sum("tfidf")).alias("weight"), r6(F.max("tfidf")).alias("top")
    )


def known_token_means(spark, d):
    """Document means over a token table derived from the corpus: length, digits, share of documents."""
    corpus = texts(spark, d)
    counts = cut(wordvec.token_counts(corpus))
    vectors = counts.groupBy("token").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where("df >= 2")
    vectors = vectors.select("token", F.array(
        F.length("token").cast("double"), F.log(F.col("df") + 1.0), F.col("total") / F.col("df"),
    ).alias("vec"))
    means = wordvec.mean_vectors(corpus, counts, cut(vectors))
    return means.select("id", *[r6(F.col("vec")[i]).alias(f"x{i}") for i in range(3)])


def char_ngrams(spark, d):
    words = texts(spark, d).select(F.explode(text.whitespace_tokens(F.col("text"))).alias("token")).distinct()
    spelled = words.select(text.letters(F.col("token")).alias("letters"))
    return spelled.select(F.explode(text.char_ngrams(F.col("letters"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n_words"))


def word2vec(spark, d):
    docs, _ = wordvec.build_word2vec(texts(spark, d), vector_size=100)
    return docs.select("id", F.size("vec").alias("width"), r6(F.array_max("vec")).alias("largest"))


def fasttext(spark, d):
    docs, _ = wordvec.build_fasttext(texts(spark, d))
    return docs.select("id", F.size("vec").alias("width"), r6(F.array_max("vec")).alias("largest"))


QUERIES = {
    "f1_word_tokens": (word_tokens, f"""WITH {TOKENS}
        SELECT term, count(*) AS n_tokens, count(DISTINCT doc_id) AS n_docs FROM tokens GROUP BY term"""),
    "f2_whitespace_tokens": (whitespace_tokens, f"""
        WITH t AS (SELECT unnest(regexp_split_to_array(coalesce(text, ''), '{SPACE}')) AS token FROM documents)
        SELECT token, count(*) AS n FROM t WHERE token <> '' GROUP BY token"""),
    "f3_word_ngrams": (ngrams, f"""WITH {PAIRS},
        grams AS (SELECT term AS gram FROM tokens UNION ALL
          SELECT term || ' ' || after FROM pairs WHERE after IS NOT NULL)
        SELECT gram, count(*) AS n FROM grams GROUP BY gram"""),
    "f4_document_frequency_bounds": (document_frequency_bounds, f"WITH {VOCABULARY} SELECT term, df FROM vocab"),
    "f5_max_features": (max_features, f"""WITH {COUNTS}
        SELECT term, df, total FROM freq, n WHERE df >= 2 AND df <= 0.9 * n ORDER BY total DESC, term LIMIT 1000"""),
    "f6_term_frequency": (term_frequency, f"""WITH {COUNTS}
        SELECT doc_id, term, tf, round(1.0 + ln(tf), 6) + 0.0 AS sublinear FROM tf"""),
    "f7_idf": (idf, f"""WITH {COUNTS}
        SELECT term, df, round(ln((1.0 + n) / (1.0 + df)) + 1.0, 6) + 0.0 AS idf FROM freq, n"""),
    "f8_tfidf_matrix": (tfidf_matrix, f"""WITH {WEIGHTS}
        SELECT doc_id, term, tf, df, round(tfidf, 6) + 0.0 AS tfidf FROM tfidf"""),
    "f8_tfidf_bigrams": (tfidf_bigrams, f"""WITH {PAIRS},
        grams AS (SELECT doc_id, term FROM tokens UNION ALL
          SELECT doc_id, term || ' ' || after FROM pairs WHERE after IS NOT NULL),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
        n AS (SELECT count(*) AS n FROM docs),
        freq AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term),
        vocab AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM freq, n
          WHERE df >= 3 AND df <= 0.8 * n ORDER BY total DESC, term LIMIT 5000),
        raw AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN vocab USING (term))
        SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) + 0.0 AS tfidf FROM raw"""),
    "f9_vocabulary": (vocabulary, f"""WITH {VOCABULARY}
        SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id, df, round(idf, 6) + 0.0 AS idf FROM vocab"""),
    "f9_variant_sizes": (variant_sizes, f"WITH {VARIANTS} SELECT variant, count(*) AS vocabulary FROM vv GROUP BY variant"),
    "f10_variant_grid": (variant_grid, f"""WITH {VARIANTS},
        raw AS (SELECT variant, doc_id, term,
          (CASE WHEN sub = 1 THEN 1.0 + ln(tf) ELSE tf END) * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w
          FROM tf JOIN vv USING (term), n),
        unit AS (SELECT variant, doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY variant, doc_id)) AS tfidf FROM raw)
        SELECT variant, term, count(*) AS n_docs, round(sum(tfidf), 6) + 0.0 AS weight, round(max(tfidf), 6) + 0.0 AS top
        FROM unit GROUP BY ALL"""),
    "f11_word2vec": (word2vec, None),
    "f12_known_token_means": (known_token_means, f"""
        WITH t AS (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '{SPACE}')) AS token FROM documents),
        tf AS (SELECT doc_id, token, count(*) AS tf FROM t WHERE token <> '' GROUP BY ALL),
        v AS (SELECT token, length(token)::DOUBLE AS x0, ln(1.0 + count(*)) AS x1, sum(tf)::DOUBLE / count(*) AS x2
          FROM tf GROUP BY token HAVING count(*) >= 2),
        m AS (SELECT doc_id, sum(tf * x0) / sum(tf) AS x0, sum(tf * x1) / sum(tf) AS x1, sum(tf * x2) / sum(tf) AS x2
          FROM tf JOIN v USING (token) GROUP BY doc_id)
        SELECT doc_id AS id, round(coalesce(x0, 0.0), 6) + 0.0 AS x0, round(coalesce(x1, 0.0), 6) + 0.0 AS x1,
          round(coalesce(x2, 0.0), 6) + 0.0 AS x2
        FROM documents LEFT JOIN m USING (doc_id)"""),
    "f13_char_ngrams": (char_ngrams, f"""
        WITH t AS (SELECT DISTINCT unnest(regexp_split_to_array(coalesce(text, ''), '{SPACE}')) AS token FROM documents),
        m AS (SELECT '<' || token || '>' AS w FROM t WHERE token <> ''),
        s AS (SELECT w, unnest([3, 4, 5, 6]) AS n FROM m),
        g AS (SELECT unnest(list_transform(range(1, length(w) - n + 2), lambda i: substr(w, i, n))) AS gram FROM s WHERE length(w) >= n)
        SELECT gram, count(*) AS n_words FROM g GROUP BY gram"""),
    "f13_subword_vectors": (fasttext, None),
}
