from pyspark.sql import functions as F

from docgroups.llm import toxicity


def test_training_leaves_nothing_cached(spark):
    docs = spark.createDataFrame([(i, f"good words {i % 7}" if i % 2 else f"bad words {i % 5}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 % 2, (i + 1) % 2) for i in range(80)], "doc_id long, quality int, toxic int")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = toxicity.train(docs, labels, {"low": F.col("quality") == 0, "toxic": F.col("toxic") == 1})
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    kept = {r["doc_id"] for r in toxicity.drop_category(docs, model, "toxic").collect()}
    assert kept == set(range(1, 80, 2))
