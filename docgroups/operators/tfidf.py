"""TF-IDF as long tables.

A corpus is ``(doc_id, text, ...)`` with unique ids. Terms are counted inside the row of their document, so texts are read
once and stay where they are: only counts move, for the document frequencies and for the norm of a document. Texts of fewer files than there
are cores are dealt to all cores first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgroups.functions.text import ngrams, word_tokens
from docgroups.session import broadcast_if_small, cut

# The four vectorizer settings that are compared.
VARIANTS = {
    "default": {"min_df": 1, "max_df": 1.0, "sublinear_tf": False},
    "min_df5": {"min_df": 5, "max_df": 1.0, "sublinear_tf": False},
    "min_df5_sublinear": {"min_df": 5, "max_df": 1.0, "sublinear_tf": True},
    "min_df5_maxdf05_sublinear": {"min_df": 5, "max_df": 0.5, "sublinear_tf": True},
}


def df_bound(value, n_docs: int) -> float:
    """An int is a number of documents, a float a share of them."""
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise TypeError("document frequency bounds are int or float")
    if isinstance(value, float):
        if not 0.0 <= value <= 1.0:
            raise ValueError("a share lies between 0.0 and 1.0")
        return value * n_docs
    if value < 0:
        raise ValueError("a count is not negative")
    return value


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def counted(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of an array of terms: runs of equal ones once it is sorted."""

    def runs(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return _let(starts, lambda at: F.transform(at, lambda p, j: F.struct(
            F.get(ordered, p).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(ordered)) - p).cast("long").alias("tf")
        )))

    none = F.array().cast("array<struct<term:string,tf:bigint>>")
    # sort_array compares strings as they are; array_sort would evaluate a comparison expression for every pair.
    return _let(F.sort_array(terms), lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)).otherwise(none))


def _terms(corpus: DataFrame, ngram_range: tuple[int, int]) -> DataFrame:
    """``(doc_id, terms)``: all occurrences, in the row of their document."""
    corpus = corpus.select("doc_id", "text")
    if len(corpus.inputFiles()) < corpus.sparkSession.sparkContext.defaultParallelism:
        corpus = corpus.repartition("doc_id")
    tokens = corpus.select("doc_id", word_tokens(F.col("text")).alias("tokens"))
    terms = F.col("tokens") if ngram_range == (1, 1) else _let(F.col("tokens"), lambda t: ngrams(t, *ngram_range))
    return tokens.select("doc_id", terms.alias("terms"))


def packed_counts(corpus: DataFrame, ngram_range: tuple[int, int] = (1, 1)) -> DataFrame:
    """``(doc_id, cells)``: the terms of each document with their counts, in its row."""
    return _terms(corpus, ngram_range).select("doc_id", counted(F.col("terms")).alias("cells"))


def term_totals(corpus: DataFrame, ngram_range: tuple[int, int] = (1, 1)) -> DataFrame:
    """``(term, total)``: occurrences in the whole corpus; no document's terms are sorted for it."""
    return _terms(corpus, ngram_range).select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("total"))


def unpacked(packed: DataFrame) -> DataFrame:
    """``(doc_id, term, tf)`` of packed counts."""
    return packed.select("doc_id", F.explode("cells").alias("cell")).select("doc_id", "cell.term", "cell.tf")


def term_counts(corpus: DataFrame, ngram_range: tuple[int, int] = (1, 1)) -> DataFrame:
    """``(doc_id, term, tf)``."""
    return unpacked(packed_counts(corpus, ngram_range))


def document_frequencies(counts: DataFrame) -> DataFrame:
    """``(term, df, total)``; counts are combined before the shuffle, so common terms cost no more."""
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))


def keep_terms(frequencies: DataFrame, n_docs: int, min_df, max_df, max_features: int | None = None) -> DataFrame:
    """Terms within both bounds, then the ``max_features`` with the largest total count."""
    low, high = df_bound(min_df, n_docs), df_bound(max_df, n_docs)
    if high < low:
        raise ValueError("max_df keeps fewer documents than min_df")
    kept = frequencies.where(F.col("df").between(F.lit(low), F.lit(high)))
    if max_features is not None:
        kept = kept.orderBy(F.desc("total"), "term").limit(max_features)
    return kept


def smooth_idf(df: Column, n_docs: int) -> Column:
    return F.log(F.lit(1.0 + n_docs) / (df + 1.0)) + 1.0


def tf_weight(tf: Column, sublinear: bool) -> Column:
    return F.log(tf.cast("double")) + 1.0 if sublinear else tf.cast("double")


def unit_rows(weights: DataFrame, keys: list[str]) -> DataFrame:
    """Divide ``w`` by the L2 norm of its row."""
    row = Window.partitionBy(*keys)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(row))
    return weights.withColumn("tfidf", F.col("w") / norm).drop("w")


def weigh(counts: DataFrame, vocabulary: DataFrame, sublinear_tf: bool = True) -> DataFrame:
    """``(doc_id, term, tf, df, tfidf)`` for the terms of a vocabulary."""
    joined = counts.join(broadcast_if_small(vocabulary.select("term", "df", "idf")), "term")
    weight = tf_weight(F.col("tf"), sublinear_tf) * F.col("idf")
    rows = joined.select("doc_id", "term", "tf", "df", weight.alias("w"))
    return unit_rows(rows, ["doc_id"])


def fit_vocabulary(
    counts: DataFrame, n_docs: int, min_df=5, max_df=0.5, max_features: int | None = None
) -> DataFrame:
    """``(term, df, idf)``, checkpointed: the next steps read it more than once."""
    kept = keep_terms(document_frequencies(counts), n_docs, min_df, max_df, max_features)
    return cut(kept.select("term", "df", smooth_idf(F.col("df"), n_docs).alias("idf")))


def build_tfidf(
    corpus: DataFrame,
    min_df=5,
    max_df=0.5,
    sublinear_tf: bool = True,
    max_features: int | None = None,
    ngram_range: tuple[int, int] = (1, 1),
) -> tuple[DataFrame, DataFrame]:
    """The weighted rows and the vocabulary. Documents without a known term have no weighted row.

    Counts are written once, for the vocabulary and for the weights.
    """
    counts = unpacked(cut(packed_counts(corpus, ngram_range)))
    vocabulary = fit_vocabulary(counts, corpus.count(), min_df, max_df, max_features)
    return weigh(counts, vocabulary, sublinear_tf), vocabulary


def variant_vocabularies(frequencies: DataFrame, n_docs: int, variants: dict = VARIANTS) -> DataFrame:
    """``(variant, term, df)`` for every setting, from one frequency table."""
    bounds = [
        F.struct(
            F.lit(name).alias("variant"),
            F.lit(float(df_bound(v["min_df"], n_docs))).alias("low"),
            F.lit(float(df_bound(v["max_df"], n_docs))).alias("high"),
        )
        for name, v in variants.items()
    ]
    rows = frequencies.withColumn("v", F.explode(F.array(*bounds)))
    return rows.where("df BETWEEN v.low AND v.high").select("v.variant", "term", "df")


def zero_rows(corpus: DataFrame, weights: DataFrame) -> DataFrame:
    """Ids of documents with no weighted term."""
    return corpus.select("doc_id").join(weights.select("doc_id").distinct(), "doc_id", "left_anti")


def matrix_shape(corpus: DataFrame, weights: DataFrame) -> DataFrame:
    """One row ``(n_docs, n_terms, n_nonzero)``."""
    per_term = weights.groupBy("term").agg(F.count("*").alias("n"))
    parts = per_term.select(F.lit(0).alias("docs"), F.lit(1).alias("terms"), F.col("n").alias("nonzero"))
    parts = parts.unionAll(corpus.select(F.lit(1), F.lit(0), F.lit(0).cast("long")))
    return parts.agg(
        F.sum("docs").alias("n_docs"),
        F.sum("terms").alias("n_terms"),
        F.sum("nonzero").alias("n_nonzero"),
    )


def ranked_terms(vocabulary: DataFrame) -> DataFrame:
    """Add ``term_id``: the place of each term in sorted order.

    Range partitions are ranked on their own and shifted by the sizes of the earlier ones.
    """
    parts = cut(vocabulary.repartitionByRange("term").withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy("term")) - 1
    ranked = parts.withColumn("place", place).join(F.broadcast(shifts), "part")
    return ranked.select(*vocabulary.columns, (F.col("place") + F.col("shift")).cast("long").alias("term_id"))


def packed_rows(weights: DataFrame, terms: DataFrame) -> DataFrame:
    """``(id, idx, val)``: one sparse row per document, term ids ascending."""
    joined = weights.join(broadcast_if_small(terms.select("term", "term_id")), "term")
    entries = F.array_sort(F.collect_list(F.struct("term_id", "tfidf")))
    rows = joined.groupBy(F.col("doc_id").alias("id")).agg(entries.alias("entries"))
    return rows.select("id", F.col("entries.term_id").alias("idx"), F.col("entries.tfidf").alias("val"))


def with_zero_rows(packed: DataFrame, corpus: DataFrame) -> DataFrame:
    """Add the documents without a weighted term as empty rows."""
    every = corpus.select(F.col("doc_id").alias("id")).join(packed, "id", "left")
    return every.select(
        "id", F.coalesce("idx", F.array().cast("array<long>")).alias("idx"),
        F.coalesce("val", F.array().cast("array<double>")).alias("val"),
    )


def variant_weights(counts: DataFrame, vocabularies: DataFrame, n_docs: int, variants: dict = VARIANTS) -> DataFrame:
    """``(variant, doc_id, term, tfidf)`` of all settings, from one count of the tokens.

    A term of a document is one row with a weight for each setting until the norms are known.
    """
    flags = [F.max(F.col("variant") == name).alias(f"in_{i}") for i, name in enumerate(variants)]
    held = vocabularies.groupBy("term", "df").agg(*flags)
    joined = counts.join(broadcast_if_small(cut(held)), "term")
    weights = [
        F.when(F.col(f"in_{i}"), tf_weight(F.col("tf"), v["sublinear_tf"]) * smooth_idf(F.col("df"), n_docs)).alias(f"w_{i}")
        for i, v in enumerate(variants.values())
    ]
    rows = joined.select("doc_id", "term", *weights)
    document = Window.partitionBy("doc_id")
    norms = [F.sqrt(F.sum(F.col(f"w_{i}") * F.col(f"w_{i}")).over(document)).alias(f"n_{i}") for i in range(len(weights))]
    rows = rows.select("*", *norms)
    each = F.explode(F.array(*[
        F.struct(F.lit(name).alias("variant"), (F.col(f"w_{i}") / F.col(f"n_{i}")).alias("tfidf")) for i, name in enumerate(variants)
    ]))
    return rows.select("doc_id", "term", each.alias("v")).select("v.variant", "doc_id", "term", "v.tfidf").where("tfidf IS NOT NULL")
