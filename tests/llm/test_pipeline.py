"""The pipeline: what each stage keeps and changes."""

import corpus_pipeline
from docgroups.llm import secrets

SMALL = "/root/testdata/sf0.01"


def test_stages_in_turn(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == columns
        counts.append(docs.count())
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = spark.read.parquet(f"{tmp_path}/1").join(labels, "doc_id")
    assert kept.where("toxic = 1").count() <= 0.1 * labels.where("toxic = 1").count()
    assert kept.where("toxic = 0").count() >= 0.99 * labels.where("toxic = 0").count()
    assert counts[1] == counts[0] and counts[2] > counts[3] == counts[4] > 800
    assert secrets.digests(docs).where("n_assign + n_access + n_hex > 0").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == counts[-1]
