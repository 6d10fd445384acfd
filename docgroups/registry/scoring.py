"""Scores and the choice of k, on groupings the SQL side can rebuild."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgroups.functions.arrays import matrix
from docgroups.operators import kselect, scores, silhouette, tables
from docgroups.operators.kmeans import label_sweep
from docgroups.operators.reduce import first_components
from docgroups.plans import reports, sweeps
from docgroups.registry.common import embeddings, r6, table
from docgroups.session import cut

SIZES, KS = [8, 16, 32, 64], list(range(2, 11))


def score_sql(rows: str, truth: str, cluster: str, keys: str = "run") -> str:
    """CTEs ending in ``scored(keys, n, n_classes, n_clusters, nmi, ari, ami)``."""
    on = ", ".join(keys.split(","))
    return f"""cells AS (SELECT {on}, {truth} AS t, {cluster} AS c, count(*)::DOUBLE AS m FROM {rows} GROUP BY ALL),
    ma AS (SELECT {on}, t, sum(m) AS a FROM cells GROUP BY ALL),
    mb AS (SELECT {on}, c, sum(m) AS b FROM cells GROUP BY ALL),
    tot AS (SELECT {on}, sum(m) AS n, sum(m * (m - 1) / 2) AS p FROM cells GROUP BY ALL),
    ha AS (SELECT {on}, count(*) AS ka, -sum(a / n * ln(a / n)) AS h, sum(a * (a - 1) / 2) AS p FROM ma JOIN tot USING ({on}) GROUP BY ALL),
    hb AS (SELECT {on}, count(*) AS kb, -sum(b / n * ln(b / n)) AS h, sum(b * (b - 1) / 2) AS p FROM mb JOIN tot USING ({on}) GROUP BY ALL),
    mi AS (SELECT {on}, sum(m / n * ln(n * m / (a * b))) AS mi FROM cells JOIN ma USING ({on}, t) JOIN mb USING ({on}, c) JOIN tot USING ({on}) GROUP BY ALL),
    ov AS (SELECT {on}, a, b, n, unnest(range(greatest(1, a + b - n)::BIGINT, least(a, b)::BIGINT + 1))::DOUBLE AS o
      FROM ma JOIN mb USING ({on}) JOIN tot USING ({on})),
    emi AS (SELECT {on}, sum(o / n * ln(n * o / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(n - a + 1) + lgamma(n - b + 1)
      - lgamma(n + 1) - lgamma(o + 1) - lgamma(a - o + 1) - lgamma(b - o + 1) - lgamma(n - a - b + o + 1))) AS emi FROM ov GROUP BY ALL),
    scored AS (SELECT {on}, n::BIGINT AS n, ka AS n_classes, kb AS n_clusters, mi / ((ha.h + hb.h) / 2) AS nmi,
      (tot.p - ha.p * hb.p / (n * (n - 1) / 2)) / ((ha.p + hb.p) / 2 - ha.p * hb.p / (n * (n - 1) / 2)) AS ari,
      (mi - emi) / ((ha.h + hb.h) / 2 - emi) AS ami
      FROM tot JOIN ha USING ({on}) JOIN hb USING ({on}) JOIN mi USING ({on}) JOIN emi USING ({on}))"""


SWEEP = """v AS (SELECT vec_id AS id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
sz(n_components) AS (VALUES (8), (16), (32), (64)),
u AS (SELECT n_components, id, label, d, x / sqrt(sum(x * x) OVER (PARTITION BY n_components, id)) AS x FROM v, sz WHERE d <= n_components),
ks AS (SELECT unnest(range(2, 11))::INTEGER AS k),
cen AS (SELECT n_components, k, (label * k) // 10 AS c, d, avg(x) AS x FROM u, ks GROUP BY ALL),
dist AS (SELECT u.n_components, k, id, label, c, sum((u.x - cen.x) ** 2) AS d2
  FROM u JOIN cen ON u.n_components = cen.n_components AND u.d = cen.d GROUP BY ALL),
pick AS (SELECT *, row_number() OVER (PARTITION BY n_components, k, id ORDER BY d2, c) AS rn FROM dist),
asg AS (SELECT n_components, k, id, label, c, d2 FROM pick WHERE rn = 1),
cost AS (SELECT n_components, k, sum(d2) AS inertia FROM asg GROUP BY ALL),
cs AS (SELECT n_components, k, c, count(*) AS m FROM asg GROUP BY ALL),
sums AS (SELECT a.n_components, a.k, a.c, u.d, sum(u.x) AS s FROM asg a JOIN u ON a.n_components = u.n_components AND a.id = u.id GROUP BY ALL),
dots AS (SELECT u.n_components, k, id, c, sum(u.x * s) AS dot FROM u JOIN sums ON u.n_components = sums.n_components AND u.d = sums.d GROUP BY ALL),
ab AS (SELECT asg.n_components, asg.k, asg.id,
  max(CASE WHEN dots.c = asg.c THEN CASE WHEN m > 1 THEN 1 - (dot - 1) / (m - 1) ELSE 0 END END) AS a,
  max(CASE WHEN dots.c = asg.c THEN m END) AS own, min(CASE WHEN dots.c <> asg.c THEN 1 - dot / m END) AS b
  FROM asg JOIN dots ON asg.n_components = dots.n_components AND asg.k = dots.k AND asg.id = dots.id
  JOIN cs ON cs.n_components = dots.n_components AND cs.k = dots.k AND cs.c = dots.c GROUP BY ALL),
sil AS (SELECT n_components, k, avg(CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab GROUP BY ALL),
""" + score_sql("asg", "label", "c", "n_components,k") + """,
sweep AS (SELECT n_components, k, inertia, silhouette, nmi, ari, ami FROM cost JOIN sil USING (n_components, k) JOIN scored USING (n_components, k)),
best_s AS (SELECT n_components, k FROM (SELECT *, row_number() OVER (PARTITION BY n_components ORDER BY silhouette DESC, k) AS rn FROM sweep) WHERE rn = 1),
ends AS (SELECT n_components, min(k) AS k0, max(k) AS k1, min(inertia) AS lo, max(inertia) AS hi,
  arg_min(inertia, k) AS f, arg_max(inertia, k) AS l FROM sweep GROUP BY ALL),
scaled AS (SELECT n_components, k, (k - k0) / (k1 - k0)::DOUBLE AS x, (inertia - lo) / (hi - lo) AS y,
  (f - lo) / (hi - lo) AS y0, (l - lo) / (hi - lo) AS y1 FROM sweep JOIN ends USING (n_components)),
away AS (SELECT n_components, k, round(abs((y1 - y0) * x - y + y0) / sqrt((y1 - y0) ** 2 + 1), 12) AS away FROM scaled),
best_e AS (SELECT n_components, k FROM (SELECT *, row_number() OVER (PARTITION BY n_components ORDER BY away DESC, k) AS rn FROM away) WHERE rn = 1),
best_n AS (SELECT n_components, k FROM (SELECT *, row_number() OVER (PARTITION BY n_components ORDER BY nmi DESC, k) AS rn FROM sweep) WHERE rn = 1),
chosen AS (SELECT 'silhouette' AS rule, * FROM best_s UNION ALL SELECT 'elbow', * FROM best_e UNION ALL SELECT 'ceiling', * FROM best_n),
results AS (SELECT CASE WHEN n_components <= 16 THEN 'short' ELSE 'long' END AS dataset,
  CASE WHEN rule = 'ceiling' THEN 'labels' ELSE 'kmeans' END AS algorithm, n_components, rule AS k_method, k,
  nmi, ari, ami, silhouette FROM chosen JOIN sweep USING (n_components, k))"""

def _gaps(centres: list[np.ndarray]):
    """Per batch and k of ``KS``: the summed squared distance of rows to the centre of their label."""
    def measure(batches):
        for t in batches:
            if t.num_rows:
                x, labels = matrix(t["vec"]), matrix(t["labels"])
                cost = [float(((x - c[labels[:, g]]) ** 2).sum()) for g, c in enumerate(centres)]
                yield pa.RecordBatch.from_pydict({"k": pa.array(KS, pa.int32()), "inertia": cost})

    return measure


def _build_sweep(spark, d) -> DataFrame:
    """One Lloyd step from coarser and coarser classes, at several prefix sizes of the vectors."""
    rows = cut(embeddings(spark, d))
    coarse = F.array(*[F.floor(F.col("label") * k / 10).cast("int") for k in KS])
    parts = []
    for size in SIZES:
        start = first_components(rows, size).withColumn("labels", coarse)
        sizes, sums = silhouette.group_sums(start, KS)
        fits = {(size, k): (s / n[:, None], 0.0) for k, n, s in zip(KS, sizes, sums)}
        grouped = cut(label_sweep(rows, fits, size, KS))
        long = sweeps.long_labels(grouped, KS, size, rows)
        means = silhouette.mean_silhouettes(grouped, KS, "cosine")
        counts = F.array(*[F.lit(k) for k in KS])
        means = means.select(F.get(counts, F.col("g")).alias("k"), "silhouette")
        # Labels of all k meet their row's vector at once, not a centre for each k.
        near = grouped.select("id", "labels").join(grouped.select("id", "vec"), "id").select("labels", "vec")
        cost = near.mapInArrow(_gaps([fits[(size, k)][0] for k in KS]), "k int, inertia double")
        cost = cost.groupBy(F.lit(size).alias("n_components"), "k").agg(F.sum("inertia").alias("inertia"))
        scored = scores.score_groups(long, keys=("n_components", "k"))
        parts.append(cost.join(means, "k").join(scored.select("k", "nmi", "ari", "ami"), "k").select(
            "n_components", "k", "inertia", "silhouette", "nmi", "ari", "ami"
        ))
    return reduce(DataFrame.unionByName, parts)


def sweep_table(spark, d) -> DataFrame:
    return cut(_build_sweep(spark, d))


def results_table(spark, d) -> DataFrame:
    sweep = sweep_table(spark, d)
    chosen = kselect.gap_report(sweep, ("n_components",)).select("n_components", "rule", "k")
    rows = chosen.join(sweep, ["n_components", "k"])
    return rows.select(
        F.when(F.col("n_components") <= 16, "short").otherwise("long").alias("dataset"),
        F.when(F.col("rule") == "ceiling", "labels").otherwise("kmeans").alias("algorithm"),
        "n_components", F.col("rule").alias("k_method"), "k", "nmi", "ari", "ami", "silhouette",
    )


def _rounded(df: DataFrame) -> DataFrame:
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[r6(c).alias(c) if c in doubles else F.col(c) for c in df.columns])


ROUND = "round(inertia, 6) + 0.0 AS inertia, round(silhouette, 6) + 0.0 AS silhouette"
METRICS = "round(nmi, 6) + 0.0 AS nmi, round(ari, 6) + 0.0 AS ari, round(ami, 6) + 0.0 AS ami"


def _sources(spark, d):
    rows = table(spark, d, "documents")
    noise = F.when(F.col("n_chars") < 300, -1).otherwise(F.regexp_extract("source", "[0-9]+", 0).cast("int"))
    return rows.select("doc_id", F.col("lang").alias("label"), noise.alias("cluster"))


DOC_GROUPS = """rows AS (SELECT 1 AS run, doc_id, lang AS label,
  CASE WHEN n_chars < 300 THEN -1 ELSE regexp_extract(source, '[0-9]+')::INTEGER END AS cluster FROM documents)"""


def silhouette_rows(method: str):
    def query(spark, d):
        grouped = embeddings(spark, d).withColumn("labels", F.array("label"))
        rows = silhouette.METHODS[method](grouped, [10])
        return rows.select("id", *[r6(F.col(c)[0]).alias(c) for c in ("a", "b", "s")])
    return query


def many_groups(spark, d):
    rows = embeddings(spark, d).select("id", "vec", F.col("label").cast("long").alias("cluster"))
    return _rounded(silhouette.many_group_silhouettes(rows).select("id", "cluster", "a", "b", "s"))


def masked(spark, d):
    cluster = F.when(F.col("label") == 0, -1).otherwise(F.col("label")).cast("long")
    return _rounded(silhouette.masked_silhouette(embeddings(spark, d).select("id", "vec", cluster.alias("cluster"))))


def _silhouette_sql(distance: str, where: str = "true") -> str:
    return f"""WITH e AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE {where}),
    u AS (SELECT id, label, v, sqrt(list_inner_product(v, v)) AS l FROM e),
    p AS (SELECT x.id, x.label, y.label AS other, x.id = y.id AS self, CASE WHEN x.id = y.id THEN 0.0 ELSE {distance} END AS dist FROM u x, u y),
    g AS (SELECT id, label, other, sum(dist) AS total, count(*) AS m FROM p GROUP BY ALL),
    r AS (SELECT id, label, max(CASE WHEN other = label THEN CASE WHEN m > 1 THEN total / (m - 1) ELSE 0 END END) AS a,
      max(CASE WHEN other = label THEN m END) AS own, min(CASE WHEN other <> label THEN total / m END) AS b FROM g GROUP BY ALL),
    s AS (SELECT id, label, a, b, CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM r)"""


COSINE = "1 - list_inner_product(x.v, y.v) / (x.l * y.l)"
EUCLIDEAN = f"sqrt(greatest(0, 2 * ({COSINE})))"
ABS = "round(a, 6) + 0.0 AS a, round(b, 6) + 0.0 AS b, round(s, 6) + 0.0 AS s"


def contingency(spark, d):
    return scores.contingency(_sources(spark, d))


def one_score(name: str):
    return lambda spark, d: scores.score_groups(_sources(spark, d)).select(r6(name).alias(name))


def bundle(spark, d):
    return _rounded(scores.score_groups(_sources(spark, d)))


def partial_truth(spark, d):
    """Scores of the languages against the quality labels, which cover some documents."""
    rows = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id")
    rows = rows.select(F.col("quality").alias("label"), F.col("lang").alias("cluster"))
    return _rounded(scores.score_groups(rows))


def noise(spark, d):
    return _sources(spark, d).agg(r6(scores.noise_fraction(F.col("cluster"))).alias("noise_fraction"))


def result_row(spark, d):
    rows = _sources(spark, d).withColumn("k", F.lit(20))
    return _rounded(scores.result_rows(rows, "documents", "none", "source", keys=("k",)))


def cluster_counts(spark, d):
    return scores.count_clusters(_sources(spark, d))


def scored_sweep(spark, d):
    return _rounded(sweep_table(spark, d))


def best_silhouette(spark, d):
    return kselect.best_k_by_silhouette(sweep_table(spark, d), ("n_components",))


def best_elbow(spark, d):
    return kselect.best_k_by_elbow(sweep_table(spark, d), ("n_components",))


def gaps(spark, d):
    return _rounded(kselect.gap_report(sweep_table(spark, d), ("n_components",)))


def kmeans_rows(spark, d):
    rows = results_table(spark, d).where("algorithm = 'kmeans' AND k_method = 'elbow'")
    return _rounded(rows.select("n_components", "k", "nmi"))


def best_per_group(spark, d):
    best = tables.best_rows(results_table(spark, d), "nmi", ["dataset", "algorithm"], ["n_components", "k_method", "k"])
    return _rounded(best.select("dataset", "algorithm", "n_components", "k", "nmi"))


def best_overall(spark, d):
    best = tables.best_rows(sweep_table(spark, d), "nmi", [], ["n_components", "k"])
    return _rounded(best.select("n_components", "k", "nmi"))


def silhouette_at_k(spark, d):
    sweep = sweep_table(spark, d)
    chosen = kselect.best_k_by_elbow(sweep, ("n_components",))
    return _rounded(tables.at_chosen_k(sweep, chosen, "silhouette", ["n_components"]))


def tagged_union(spark, d):
    sweep = sweep_table(spark, d)
    parts = {size: sweep.where(F.col("n_components") == size).select("k", "inertia", "nmi") for size in SIZES}
    return _rounded(tables.union_tagged(parts, "components"))


def sorted_results(spark, d):
    rows = results_table(spark, d).orderBy(F.desc("dataset"), "algorithm", "n_components", "k_method")
    return _rounded(rows.select("dataset", "algorithm", "n_components", "k_method", "nmi"))


def distinct_sorted(spark, d):
    return results_table(spark, d).select("n_components").distinct().orderBy("n_components")


def column_max(spark, d):
    top = sweep_table(spark, d).groupBy("n_components").agg(F.max("silhouette").alias("silhouette"))
    return _rounded(top)


def degenerate(spark, d):
    return tables.near_zero(sweep_table(spark, d)).select("n_components", "k", "degenerate")


def comparison(spark, d):
    return _rounded(reports.metric_comparison(results_table(spark, d)))


def by_components(spark, d):
    return _rounded(reports.scores_by_components(results_table(spark, d)))


def curves(spark, d):
    sweep = sweep_table(spark, d)
    return _rounded(reports.selection_curves(sweep.where("n_components = 64")))


SCORED = f"WITH {DOC_GROUPS}, {score_sql('rows', 'label', 'cluster')}"
BEST = """SELECT dataset, algorithm, n_components, k, nmi, ari, ami FROM (SELECT *, row_number() OVER
  (PARTITION BY dataset, algorithm ORDER BY nmi DESC, n_components, k_method, k) AS rn FROM results) WHERE rn = 1"""

QUERIES = {
    "e1_euclidean_silhouette": (silhouette_rows("euclidean"), _silhouette_sql(EUCLIDEAN) + f" SELECT id, {ABS} FROM s"),
    "e1_squared_silhouette": (silhouette_rows("squared"), _silhouette_sql(f"2 * ({COSINE})") + f" SELECT id, {ABS} FROM s"),
    "e2_cosine_silhouette": (silhouette_rows("cosine"), _silhouette_sql(COSINE) + f" SELECT id, {ABS} FROM s"),
    "e2_many_group_silhouette": (many_groups, _silhouette_sql(COSINE) + f" SELECT id, label::BIGINT AS cluster, {ABS} FROM s"),
    "e3_masked_silhouette": (masked, _silhouette_sql(COSINE, "label <> 0") + " SELECT round(avg(s), 6) + 0.0 AS silhouette FROM s"),
    "e4_contingency": (contingency, f"WITH {DOC_GROUPS} SELECT label, cluster, count(*) AS n FROM rows GROUP BY ALL"),
    "e5_nmi": (one_score("nmi"), SCORED + " SELECT round(nmi, 6) + 0.0 AS nmi FROM scored"),
    "e6_ari": (one_score("ari"), SCORED + " SELECT round(ari, 6) + 0.0 AS ari FROM scored"),
    "e7_ami": (one_score("ami"), SCORED + " SELECT round(ami, 6) + 0.0 AS ami FROM scored"),
    "e8_score_bundle": (bundle, SCORED + f" SELECT n, n_classes, n_clusters, {METRICS} FROM scored"),
    "e8_partial_truth": (partial_truth, f"""WITH rows AS (SELECT 1 AS run, quality AS label, lang AS cluster FROM labels JOIN documents USING (doc_id)),
        {score_sql('rows', 'label', 'cluster')} SELECT n, n_classes, n_clusters, {METRICS} FROM scored"""),
    "e9_noise_fraction": (noise, f"WITH {DOC_GROUPS} SELECT round(avg((cluster = -1)::INTEGER), 6) + 0.0 AS noise_fraction FROM rows"),
    "e10_result_row": (result_row, SCORED + f""" SELECT 'documents' AS dataset, 'none' AS embedding, 'source' AS algorithm,
        NULL::INTEGER AS n_components, NULL::VARCHAR AS k_method, 20 AS k, {METRICS}, NULL::DOUBLE AS silhouette,
        (SELECT round(avg((cluster = -1)::INTEGER), 6) + 0.0 FROM rows) AS noise_fraction FROM scored"""),
    "h5_cluster_counts": (cluster_counts, f"""WITH {DOC_GROUPS} SELECT count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters,
        count(*) FILTER (cluster = -1) AS n_noise, count(DISTINCT cluster) AS n_labels FROM rows"""),
    "k3_best_k_by_silhouette": (best_silhouette, f"WITH {SWEEP} SELECT n_components, k FROM best_s"),
    "k4_best_k_by_elbow": (best_elbow, f"WITH {SWEEP} SELECT n_components, k FROM best_e"),
    "k5_scored_sweep_step": (scored_sweep, f"WITH {SWEEP} SELECT n_components, k, {ROUND}, {METRICS} FROM sweep"),
    "k6_gap_report": (gaps, f"WITH {SWEEP} SELECT n_components, rule, k, {METRICS} FROM chosen JOIN sweep USING (n_components, k)"),
    "p7_filter": (kmeans_rows, f"""WITH {SWEEP} SELECT n_components, k, round(nmi, 6) + 0.0 AS nmi FROM results
        WHERE algorithm = 'kmeans' AND k_method = 'elbow'"""),
    "p8_best_per_group": (best_per_group, f"""WITH {SWEEP}, best AS ({BEST})
        SELECT dataset, algorithm, n_components, k, round(nmi, 6) + 0.0 AS nmi FROM best"""),
    "p9_best_overall": (best_overall, f"WITH {SWEEP} SELECT n_components, k, round(nmi, 6) + 0.0 AS nmi FROM sweep ORDER BY sweep.nmi DESC, n_components, k LIMIT 1"),
    "p10_silhouette_at_k": (silhouette_at_k, f"""WITH {SWEEP} SELECT n_components, k, round(silhouette, 6) + 0.0 AS silhouette
        FROM best_e JOIN sweep USING (n_components, k)"""),
    "p11_tagged_union": (tagged_union, f"""WITH {SWEEP} SELECT n_components AS components, k, round(inertia, 6) + 0.0 AS inertia,
        round(nmi, 6) + 0.0 AS nmi FROM sweep"""),
    "p12_sorted_results": (sorted_results, f"""WITH {SWEEP} SELECT dataset, algorithm, n_components, k_method, round(nmi, 6) + 0.0 AS nmi
        FROM results ORDER BY dataset DESC, algorithm, n_components, k_method"""),
    "p13_distinct_sorted": (distinct_sorted, f"WITH {SWEEP} SELECT DISTINCT n_components FROM results ORDER BY 1"),
    "p14_column_max": (column_max, f"WITH {SWEEP} SELECT n_components, round(max(silhouette), 6) + 0.0 AS silhouette FROM sweep GROUP BY ALL"),
    "p15_degenerate": (degenerate, f"WITH {SWEEP} SELECT n_components, k, greatest(nmi, ari, ami) < 0.02 AS degenerate FROM sweep"),
    "r6_metric_comparison": (comparison, f"""WITH {SWEEP}, best AS ({BEST})
        SELECT dataset, algorithm, n_components, k, greatest(nmi, ari, ami) < 0.02 AS degenerate, metric,
          round(CASE metric WHEN 'nmi' THEN nmi WHEN 'ari' THEN ari ELSE ami END, 6) + 0.0 AS value
        FROM best, (VALUES ('nmi'), ('ari'), ('ami')) m(metric)"""),
    "r7_scores_by_components": (by_components, f"""WITH {SWEEP} SELECT dataset, k_method, n_components, round(nmi, 6) + 0.0 AS nmi
        FROM results WHERE algorithm = 'kmeans'"""),
    "r8_selection_curves": (curves, f"WITH {SWEEP} SELECT k, {ROUND} FROM sweep WHERE n_components = 64"),
}
