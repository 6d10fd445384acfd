from unittest.mock import MagicMock

import pytest
from compare import compare, database

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
FAST = [
    "s1_csv_corpus", "s3_clean_posts", "p4_stratified_hold_out", "f8_tfidf_matrix", "f10_variant_grid", "f12_known_token_means",
    "g2_nearest_neighbours", "c2_nearest_centroid", "e1_euclidean_silhouette", "e8_score_bundle", "h2_mutual_reachability",
    "k6_gap_report", "r6_metric_comparison",
]


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    assert compare(queries()[name](spark, FOLDER), database(FOLDER), oracle_sql()[name]) == ""


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    rows = entry(spark).collect()
    assert len(rows) == 6
    assert {(r["algorithm"], r["k_method"]) for r in rows} == {
        ("kmeans", "silhouette"), ("kmeans", "elbow"), ("agglomerative", "silhouette"),
    }
    assert max(r["nmi"] for r in rows) > 0.8


@pytest.mark.parametrize("name, operator", [
    ("r1_evaluate_documents", "jobs.evaluate"), ("r2_evaluate_all", "jobs.evaluate_all"), ("r2_best_of_all", "jobs.evaluate_all"),
    ("r3_scores_by_size", "jobs.scores_by_size"), ("r4_compare_variants", "jobs.compare_variants"),
    ("r4_best_per_variant", "jobs.compare_variants"), ("r5_label_free_choice", "jobs.label_free_choice"),
    ("f13_subword_vectors", "wordvec.build_fasttext"), ("h6_min_cluster_size_sweep", "density.sweep_min_cluster_size"),
])
def test_query_runs_the_whole_grid(monkeypatch, name, operator):
    from docgroups.operators import density, wordvec
    from docgroups.plans import jobs
    from docgroups.registry import features, groups
    from docgroups.registry import jobs as registered

    for module in (features, groups, registered):
        for reader in ("documents", "texts", "embeddings", "read_table"):
            monkeypatch.setattr(module, reader, MagicMock(), raising=False)
    monkeypatch.setattr(jobs, "best_per_variant", MagicMock())
    module, function = operator.split(".")
    called = MagicMock()
    called.return_value.__getitem__.return_value = MagicMock()
    called.return_value.__iter__.return_value = iter([MagicMock(), MagicMock()])
    monkeypatch.setattr({"jobs": jobs, "wordvec": wordvec, "density": density}[module], function, called)
    for f in ("size", "array_max"):
        monkeypatch.setattr(features.F, f, MagicMock())
    monkeypatch.setattr(features, "r6", MagicMock())
    queries()[name](MagicMock(), FOLDER)
    args, settings = called.call_args
    assert settings == {}
    assert args[1:] == {"jobs.evaluate": ("documents",), "density.sweep_min_cluster_size": (range(3, 51),)}.get(operator, ())


def test_component_sweep_runs_the_whole_grid(monkeypatch):
    from docgroups.plans import jobs, sweeps
    from docgroups.registry import vectors

    monkeypatch.setattr(vectors, "texts", MagicMock())
    reduced, sweep = MagicMock(return_value=("vectors", [2, 300])), MagicMock()
    monkeypatch.setattr(jobs, "reduced_corpus", reduced)
    monkeypatch.setattr(sweeps, "component_sweep", sweep)
    queries()["d4_component_sweep"](MagicMock(), FOLDER)
    assert reduced.call_args.args[1] == (2, 5, 10, 20, 50, 100, 200, 300)
    assert sweep.call_args == (("vectors", [2, 300]), {})
