import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgroups.operators import kselect, labels, scores, tables

TRUTH = [0, 0, 1, 1, 2, 2]


def score(spark, truth, groups):
    rows = spark.createDataFrame(list(zip(truth, groups)), "label int, cluster int")
    return scores.score_groups(rows).first()


@pytest.mark.parametrize("groups,expected", [([5, 5, 3, 3, 9, 9], 1.0), ([0] * 6, 0.0)])
def test_known_answers(spark, groups, expected):
    r = score(spark, TRUTH, groups)
    assert (r["nmi"], r["ari"], r["ami"]) == pytest.approx((expected,) * 3, abs=1e-9)


def test_both_single(spark):
    r = score(spark, [1, 1, 1], [7, 7, 7])
    assert (r["nmi"], r["ari"], r["ami"]) == (1.0, 1.0, 1.0)


def test_hand_worked(spark):
    r = score(spark, [0, 0, 0, 1, 1, 1], [0, 0, 1, 1, 2, 2])
    mi = (2 * math.log(2) + 0 + 0 + 2 * math.log(2)) / 6
    assert r["nmi"] == pytest.approx(mi / ((math.log(2) + math.log(3)) / 2))
    assert r["ari"] == pytest.approx((2 - 6 * 3 / 15) / ((6 + 3) / 2 - 6 * 3 / 15))


def test_relabelling_and_keys(spark):
    a = [(1, i % 3, (i * 7) % 4) for i in range(40)]
    b = [(2, t, 10 - c) for _, t, c in a]
    rows = spark.createDataFrame(a + b, "run int, label int, cluster int")
    one, two = scores.score_groups(rows, keys=("run",)).orderBy("run").collect()
    assert tuple(one)[1:] == pytest.approx(tuple(two)[1:])
    assert abs(one["ami"]) < 1 and one["ami"] < one["nmi"]


def test_log_factorial(spark):
    rows = spark.range(0, 400).select("id", scores.log_factorial(F.col("id")).alias("v")).collect()
    for r in rows:
        assert r["v"] == pytest.approx(math.lgamma(r["id"] + 1), abs=1e-9)


def test_noise(spark):
    rows = spark.createDataFrame([(c,) for c in [-1, -1, 0, 0, 1, 1]], "cluster int")
    assert rows.agg(scores.noise_fraction(F.col("cluster"))).first()[0] == pytest.approx(2 / 6)
    assert tuple(scores.count_clusters(rows).first()) == (2, 2, 3)
    only = rows.where("cluster = -1")
    assert tuple(scores.count_clusters(only).first()) == (0, 2, 1)


def test_result_row(spark):
    rows = spark.createDataFrame([(0, 1, 5), (1, 2, 5), (1, -1, 5)], "label int, cluster int, k int")
    r = scores.result_rows(rows, "d", "e", "a", keys=("k",)).first()
    assert (r["dataset"], r["k"], r["n_components"], r["k_method"], r["silhouette"]) == ("d", 5, None, None, None)
    assert r["noise_fraction"] == pytest.approx(1 / 3)


def sweep(spark, rows):
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def test_best_k(spark):
    s = sweep(spark, [(2, 10.0, 0.1), (3, 5.0, None), (4, 4.0, 0.3), (5, 3.9, 0.3), (6, 3.8, float("nan"))])
    assert kselect.best_k_by_silhouette(s).first()["k"] == 4
    assert kselect.best_k_by_elbow(s).first()["k"] == 3
    flat = sweep(spark, [(2, 1.0, None), (3, 1.0, None)])
    assert kselect.best_k_by_elbow(flat).first()["k"] == 2
    assert kselect.best_k_by_silhouette(flat).count() == 0


def test_elbow_on_rising_ends(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(5):
        k = np.arange(2, 15)
        y = 100 / k + rng.normal(size=k.size) * 3
        s = sweep(spark, [(int(a), float(b), 0.0) for a, b in zip(k, y)])
        x, z = (k - k.min()) / np.ptp(k), (y - y.min()) / np.ptp(y)
        chord = np.array([x[-1] - x[0], z[-1] - z[0]])
        away = np.abs(chord[0] * (z - z[0]) - chord[1] * (x - x[0])) / np.hypot(*chord)
        assert kselect.best_k_by_elbow(s).first()["k"] == int(k[away.argmax()])


def test_best_rows_ties(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.5), ("b", 3, None), ("c", 4, 0.1)], "g string, k int, nmi double")
    assert {tuple(r) for r in tables.best_rows(df, "nmi", ["g"], ["k"]).collect()} == {("a", 1, 0.5), ("c", 4, 0.1)}


def test_hold_out_quota(spark):
    rows = spark.createDataFrame([(i, 0 if i < 700 else 1 + i % 3) for i in range(1003)], "doc_id long, label int")
    drawn = labels.stratified_sample(rows, "doc_id", "label", 0.1).groupBy("label").count().collect()
    sizes = {r["label"]: r["count"] for r in drawn}
    assert sum(sizes.values()) == 101 and sizes[0] in (70, 71) and all(10 <= sizes[c] <= 11 for c in (1, 2, 3))


def test_codes(spark):
    rows = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "label_name string")
    coded = labels.encode_labels(rows, "label_name").collect()
    assert {(r["label_name"], r["label"]) for r in coded} == {("a", 0), ("b", 1), (None, -1)}


def test_best_row_of_every_variant_and_size(spark):
    from docgroups.plans.jobs import best_per_variant

    rows = [("a", 5, 2, 0.1), ("a", 5, 3, 0.4), ("a", 5, 4, 0.4), ("a", 9, 2, 0.2), ("b", 5, 7, 0.0)]
    table = spark.createDataFrame(rows, "variant string, n_components int, k int, nmi double")
    got = best_per_variant(table).select("variant", "n_components", "k", "nmi").collect()
    assert sorted(map(tuple, got)) == [("a", 5, 3, 0.4), ("a", 9, 2, 0.2), ("b", 5, 7, 0.0)]


def test_gaps_of_all_groupings_in_one_scan(spark):
    from docgroups.registry import scoring

    rows = spark.createDataFrame([([1.0, 0.0], [0] * 9), ([0.0, 1.0], [1] * 9), ([0.0, 2.0], [1] * 9)], "vec array<double>, labels array<int>")
    centres = [np.array([[1.0, 0.0], [0.0, float(g)]]) for g in range(9)]
    found = rows.mapInArrow(scoring._gaps(centres), "k int, inertia double").groupBy("k").sum("inertia").collect()
    assert {r[0]: r[1] for r in found} == {k: (1.0 - g) ** 2 + (2.0 - g) ** 2 for g, k in enumerate(scoring.KS)}
