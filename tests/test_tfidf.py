import math

import pytest

from docgroups.operators import tfidf

DOCS = [(1, "apple apple pear"), (2, "pear plum"), (3, "pear plum plum fig"), (4, None), (5, "kiwi")]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def by_cell(weights):
    return {(r["doc_id"], r["term"]): r["tfidf"] for r in weights.collect()}


def test_weights_by_hand(corpus):
    weights, vocabulary = tfidf.build_tfidf(corpus, min_df=2, max_df=1.0, sublinear_tf=True)
    assert {r["term"]: r["df"] for r in vocabulary.collect()} == {"pear": 3, "plum": 2}
    pear, plum = math.log(6 / 4) + 1, math.log(6 / 3) + 1
    got = by_cell(weights)
    assert got[(1, "pear")] == pytest.approx(1.0)
    length = math.hypot(pear, plum * (1 + math.log(2)))
    assert got[(3, "plum")] == pytest.approx(plum * (1 + math.log(2)) / length)
    assert {r["doc_id"] for r in tfidf.zero_rows(corpus, weights).collect()} == {4, 5}
    assert tuple(tfidf.matrix_shape(corpus, weights).first()) == (5, 2, 5)


def test_bounds_depend_on_type(corpus):
    counts = tfidf.document_frequencies(tfidf.term_counts(corpus))

    def kept(low, high):
        return {r["term"] for r in tfidf.keep_terms(counts, 5, low, high).collect()}

    assert kept(1, 1) == {"apple", "fig", "kiwi"}
    assert kept(1, 1.0) == {"apple", "fig", "kiwi", "pear", "plum"}
    assert kept(0.4, 0.6) == {"pear", "plum"}
    for bad in (True, "5", None):
        with pytest.raises(TypeError):
            tfidf.df_bound(bad, 5)
    with pytest.raises(ValueError):
        kept(4, 1)


def test_max_features_and_ids(corpus):
    counts = tfidf.document_frequencies(tfidf.term_counts(corpus))
    top = tfidf.keep_terms(counts, 5, 1, 1.0, 2)
    assert {r["term"] for r in top.collect()} == {"pear", "plum"}
    ranked = tfidf.ranked_terms(counts.select("term"))
    assert [r["term"] for r in ranked.orderBy("term_id").collect()] == ["apple", "fig", "kiwi", "pear", "plum"]


def test_variants_match_single_builds(spark):
    corpus = spark.createDataFrame([(i, "aa bb " * (i % 4) + f"w{i % 3} cc") for i in range(12)], "doc_id long, text string")
    counts = tfidf.term_counts(corpus)
    vocabularies = tfidf.variant_vocabularies(tfidf.document_frequencies(counts), 12)
    weights = tfidf.variant_weights(counts, vocabularies, 12)
    for name, settings in tfidf.VARIANTS.items():
        single, _ = tfidf.build_tfidf(corpus, **settings)
        assert by_cell(weights.where(weights["variant"] == name)) == pytest.approx(by_cell(single))


def test_one_shuffle_per_text(corpus):
    weights, _ = tfidf.build_tfidf(corpus, min_df=1, max_df=1.0)
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_terms_are_counted_in_the_row(spark):
    corpus = spark.createDataFrame([(1, "bb aa bb aa bb"), (2, ""), (3, None), (4, "zz")], "doc_id long, text string")
    packed = {r["doc_id"]: [tuple(c) for c in r["cells"]] for r in tfidf.packed_counts(corpus).collect()}
    assert packed == {1: [("aa", 2), ("bb", 3)], 2: [], 3: [], 4: [("zz", 1)]}
    pairs = {r["term"]: r["tf"] for r in tfidf.term_counts(corpus.where("doc_id = 1"), (1, 2)).collect()}
    assert pairs == {"aa": 2, "bb": 3, "aa bb": 2, "bb aa": 2}


def test_texts_of_many_files_are_not_shuffled(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"aa w{i}") for i in range(64)], "doc_id long, text string")
    rows.repartition(16).write.parquet(str(tmp_path / "docs"))
    plan = tfidf.packed_counts(spark.read.parquet(str(tmp_path / "docs")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_totals_without_sorting(spark):
    corpus = spark.createDataFrame([(1, "bb aa bb"), (1, "aa"), (None, "bb aa"), (4, None)], "doc_id long, text string")
    totals = tfidf.term_totals(corpus, (1, 2))
    assert {r["term"]: r["total"] for r in totals.collect()} == {"aa": 3, "bb": 3, "bb aa": 2, "aa bb": 1}
    # A comparison expression for every pair of terms took most of the time of counting.
    for plan in (totals, tfidf.packed_counts(corpus)):
        assert "array_sort(" not in plan._jdf.queryExecution().optimizedPlan().toString()
