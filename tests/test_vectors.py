import numpy as np
import pytest
from pyspark.sql import functions as F

from docgroups.operators import geometry, kmeans, reduce, silhouette, tfidf
from docgroups.plans import sweeps

N, D = 80, 6


@pytest.fixture(scope="module")
def x():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(N, D)) + 3 * np.eye(D)[rng.integers(0, 4, size=N)]
    x[5], x[6], x[7], x[9] = x[4], x[4], 0, 0
    return x


@pytest.fixture(scope="module")
def vectors(spark, x):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, vec array<double>")


def units(x):
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def cosine(x):
    dist = np.clip(1 - units(x) @ units(x).T, 0, 2)
    np.fill_diagonal(dist, 0)
    return dist


def mean_silhouette(dist, labels):
    total = 0.0
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() > 1:
            a = dist[i][own].sum() / (own.sum() - 1)
            b = min(dist[i][labels == o].mean() for o in set(labels) - {c})
            total += (b - a) / max(a, b)
    return total / len(labels)


def test_unit_and_zero_rows(vectors, x):
    rows = geometry.l2_normalize(vectors).orderBy("id").collect()
    assert np.array([r["vec"] for r in rows]) == pytest.approx(units(x))
    flagged = geometry.flag_zero(vectors).where("is_zero").select("id").collect()
    assert {r["id"] for r in flagged} == {7, 9}


def test_copies(vectors):
    reps, members = geometry.distinct_vectors(vectors)
    assert reps.count() == N - 3
    assert {r["id"] for r in members.where("rep = 4").collect()} == {4, 5, 6}


@pytest.mark.parametrize("block_rows", [8192, 16])
def test_nearest(vectors, x, block_rows):
    rows = geometry.nearest_neighbours(vectors, 4, block_rows).collect()
    got = {(r["id"], r["rank"]): r["dist"] for r in rows}
    far = cosine(x) + np.diag(np.full(N, 9.0))
    for i in range(N):
        assert [got[(i, k)] for k in range(1, 5)] == pytest.approx(np.sort(far[i])[:4], abs=1e-12)


def test_sparse_nearest_equals_dense(spark, x):
    x = np.where(np.abs(x) > 1, x, 0)
    dense = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, vec array<double>")
    packed = spark.createDataFrame(
        [(i, np.flatnonzero(r).tolist(), r[r != 0].tolist()) for i, r in enumerate(x)], "id long, idx array<long>, val array<double>"
    )
    a, b = (geometry.nearest_neighbours(t, 3).orderBy("id", "rank").collect() for t in (dense, packed))
    assert [r["dist"] for r in a] == pytest.approx([r["dist"] for r in b], abs=1e-12)


def test_silhouettes(vectors, x):
    labels = [np.arange(N) % 4, (x[:, 0] > 0).astype(int), np.zeros(N, int), np.where(np.arange(N) == 3, 1, 0)]
    arrays = F.array(*[F.get(F.array(*[F.lit(int(v)) for v in lab]), F.col("id").cast("int")) for lab in labels])
    grouped = vectors.withColumn("labels", arrays)
    u = units(x)
    squared = ((u[:, None] - u[None]) ** 2).sum(-1)
    for method, dist in (("euclidean", np.sqrt(squared)), ("cosine", cosine(x)), ("squared", squared)):
        got = {r["g"]: r["silhouette"] for r in silhouette.mean_silhouettes(grouped, [4, 2, 1, 2], method).collect()}
        for g in (0, 1, 3):
            assert got[g] == pytest.approx(mean_silhouette(dist, labels[g]), abs=1e-9)
        assert got[2] is None


def test_many_groups_in_blocks(vectors, x):
    rows = vectors.withColumn("cluster", F.col("id") % 7)
    scores = silhouette.many_group_silhouettes(rows, group_block=3)
    assert scores.count() == N
    assert scores.agg(F.avg("s")).first()[0] == pytest.approx(mean_silhouette(cosine(x), np.arange(N) % 7))


def test_masked(vectors, x):
    rows = vectors.withColumn("cluster", F.when(F.col("id") < 20, -1).otherwise(F.col("id") % 3))
    got = silhouette.masked_silhouette(rows).first()["silhouette"]
    assert got == pytest.approx(mean_silhouette(cosine(x[20:]), np.arange(20, N) % 3))
    one = rows.withColumn("cluster", F.lit(1).cast("long"))
    assert silhouette.masked_silhouette(one).first()["silhouette"] is None


def test_pca(vectors, x):
    scores, share = reduce.pca(vectors, 3)
    got = np.array([r["vec"] for r in scores.orderBy("id").collect()])
    u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(u[:, :3] * s[:3]), abs=1e-9)
    assert share == pytest.approx((s ** 2 / (s ** 2).sum())[:3])


def test_truncated_svd(spark):
    rng = np.random.default_rng(5)
    words = [" ".join(f"w{j:02d}" for j in rng.integers(0, 12, size=9) + 12 * (i % 3)) for i in range(60)] + ["zz"]
    corpus = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    weights, vocabulary = tfidf.build_tfidf(corpus, min_df=2, max_df=1.0)
    vectors, values = reduce.truncated_svd(weights, vocabulary, corpus, 3)
    joined, joined_values = reduce.truncated_svd(weights, vocabulary, corpus, 3, basis_bytes=0)
    cells, terms = weights.collect(), sorted(r["term"] for r in vocabulary.collect())
    a = np.zeros((61, len(terms)))
    for r in cells:
        a[r["doc_id"], terms.index(r["term"])] = r["tfidf"]
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    assert values == pytest.approx(s[:3], rel=1e-3)
    got = np.array([r["vec"] for r in vectors.orderBy("id").collect()])
    assert got.shape == (61, 3) and (got[60] == 0).all()
    # The bound chooses the plan only: signs included, both give the same numbers.
    assert joined_values == pytest.approx(values, abs=1e-6)
    assert np.array([r["vec"] for r in joined.orderBy("id").collect()]) == pytest.approx(got, abs=1e-6)
    assert ((got ** 3).sum(0) > 0).all()
    want = u[:, :3] * s[:3]
    assert got @ got.T == pytest.approx(want @ want.T, abs=2e-2)


def test_sizes_that_fit():
    assert reduce.allowed_sizes((2, 5, 10, 20), 100, 11) == [2, 5, 10]


def test_kmeans(vectors, x):
    fits = kmeans.fit_sweep(vectors, [2, 4, 6], [3, D])
    u = units(x)
    for k in (2, 4, 6):
        centres, cost = fits[(D, k)]
        d2 = ((u[:, None] - centres[None]) ** 2).sum(-1)
        assert cost == pytest.approx(d2.min(1).sum())
        _, model = kmeans.run_kmeans(vectors, k)
        assert cost < 1.15 * model.summary.trainingCost
    grouped = kmeans.label_sweep(vectors, fits, 3, [2, 4, 6]).orderBy("id").collect()
    prefix = units(x[:, :3])
    assert np.array([r["vec"] for r in grouped]) == pytest.approx(prefix)
    for g, k in enumerate((2, 4, 6)):
        d2 = ((prefix[:, None] - fits[(3, k)][0][None]) ** 2).sum(-1)
        assert [r["labels"][g] for r in grouped] == d2.argmin(1).tolist()


def test_component_sweep_keeps_every_size(spark):
    # Equal rows have no silhouette at any k, but the sizes stay.
    rows = spark.createDataFrame([(i, [1.0, 0.0, 0.0]) for i in range(6)], "id long, vec array<double>")
    found = sweeps.component_sweep(rows, (2, 3), [2], method="squared").orderBy("n_components").collect()
    assert [r["n_components"] for r in found] == [2, 3]
    with pytest.raises(ValueError):
        sweeps.component_sweep(rows, (2, 4), [2])


def test_approximate_neighbours_find_nine_of_ten(spark):
    from docgroups.operators import approximate

    rng = np.random.default_rng(11)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 1500)] + 0.35 * rng.normal(size=(1500, 24))
    x[:200] = x[0]  # copies that no sign tells apart
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    exact = {(r["id"], r["rank"]): r["dist"] for r in geometry.nearest_neighbours(rows, 5).collect()}
    found = approximate.approximate_neighbours(rows, 5, bucket_rows=150).collect()
    hits = sum(r["dist"] <= exact[r["id"], 5] + 1e-9 for r in found)
    assert hits >= 0.9 * len(exact)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert all(abs(r["dist"] - max(0, 1 - u[r["id"]] @ u[r["neighbour"]])) < 1e-9 and r["id"] != r["neighbour"] for r in found)
    assert approximate.buckets(approximate.signatures(rows, 2).select("id", "table", "code"), 1500, 150).groupBy("table", "depth", "bucket").count().agg({"count": "max"}).first()[0] <= 300


def test_approximate_neighbours_of_few_rows(spark):
    from docgroups.operators import approximate

    one = spark.createDataFrame([(1, [1.0, 0.0])], "id long, vec array<double>")
    assert approximate.approximate_neighbours(one, 3).isEmpty() and approximate.approximate_neighbours(one.limit(0), 3).isEmpty()


@pytest.mark.parametrize("side_bytes", [64 * 1024 * 1024, 4000])
def test_euclidean_silhouette_in_parts(spark, side_bytes):
    """Sums of a row are handed on once for each part of all rows, and groupings, copies and zero rows count as by brute force."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 5))
    x[4], x[60], x[7], x[8] = x[3], x[3], 0, 0
    labels = np.stack([rng.integers(2, size=90), rng.integers(6, size=90)], axis=1)
    rows = [(i, v.tolist(), c.tolist()) for i, (v, c) in enumerate(zip(x, labels))]
    grouped = spark.createDataFrame(rows, "id long, vec array<double>, labels array<int>")
    length = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
    dist = np.sqrt(((u[:, None, :] - u[None, :, :]) ** 2).sum(axis=2))
    found = {r["id"]: r for r in silhouette.euclidean_silhouettes(grouped, [2, 6], side_bytes).collect()}
    for i in range(90):
        for g in range(2):
            means = {c: dist[i, labels[:, g] == c].sum() / ((labels[:, g] == c).sum() - (c == labels[i, g])) for c in set(labels[:, g])}
            a = means.pop(labels[i, g])
            assert found[i]["a"][g] == pytest.approx(a, abs=1e-7)
            assert found[i]["b"][g] == pytest.approx(min(means.values()), abs=1e-7)


def test_passes_of_the_joined_svd_leave_no_tables(spark, monkeypatch):
    """Each pass left three tables of all terms; now the tables written anew do not grow with the passes."""
    corpus = spark.createDataFrame([(i, f"w{i % 3} v{i % 5} u{i % 7}") for i in range(30)], "doc_id long, text string")
    weights, vocabulary = (reduce.cut(t) for t in tfidf.build_tfidf(corpus))
    fresh, cut = [], reduce.cut
    monkeypatch.setattr(reduce, "cut", lambda df, path=None: fresh.append(path) or (cut(df, path) if path else cut(df)))
    counts = []
    for passes in (1, 3):
        monkeypatch.setattr(reduce, "PASSES", passes)
        monkeypatch.setattr(reduce, "MAX_PASSES", passes)
        fresh.clear()
        reduce.truncated_svd(weights, vocabulary, corpus, 2, basis_bytes=0)
        counts.append((len([path for path in fresh if path is None]), len({path for path in fresh if path and "basis" in path})))
    assert counts[0][0] == counts[1][0] and counts[1][1] == 2
