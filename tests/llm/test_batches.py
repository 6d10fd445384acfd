import pyarrow as pa

from docgroups.llm import batches


def test_batches_are_bounded_by_bytes(spark):
    rows = spark.range(40, numPartitions=1).selectExpr("id", "repeat('x', 500000) text")
    before = spark.conf.get(batches.BYTES, None)
    spark.conf.unset(batches.BYTES)
    try:
        bounded = batches.bounded(rows)
        assert bounded is rows
        sizes = bounded.mapInArrow(lambda parts: (pa.RecordBatch.from_arrays([pa.array([p.num_rows])], ["id"]) for p in parts), "id long").collect()
        assert sum(r["id"] for r in sizes) == 40 and max(r["id"] for r in sizes) <= 9
        spark.conf.set(batches.BYTES, "1000000")
        batches.bounded(rows)
        assert spark.conf.get(batches.BYTES) == "1000000"
    finally:
        spark.conf.unset(batches.BYTES)
        if before is not None:
            spark.conf.set(batches.BYTES, before)
