"""Label codes, class counts and the stratified hold-out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgroups.session import broadcast_if_small, cut


def label_codes(rows: DataFrame, name: str) -> DataFrame:
    """``(name, label)``: codes 0.. in the order of the names. One row per class, not per row."""
    names = rows.where(F.col(name).isNotNull()).select(name).distinct()
    return names.withColumn("label", F.row_number().over(Window.orderBy(name)) - 1)


def encode_labels(rows: DataFrame, name: str) -> DataFrame:
    """Add ``label``; rows without a name get -1. The few codes go to the rows, not the rows to them."""
    codes = broadcast_if_small(cut(label_codes(rows, name)))
    return rows.join(codes, name, "left").withColumn("label", F.coalesce("label", F.lit(-1)))


def name_labels(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Look each ``label`` up in a ``(label, label_name)`` table."""
    return rows.join(broadcast_if_small(codes), "label", "left")


def class_counts(rows: DataFrame, name: str = "label_name") -> DataFrame:
    """Rows per class, largest first."""
    return rows.groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name)


def stratified_quota(rows: DataFrame, label: str, share: float) -> DataFrame:
    """``(label, quota)``: ceil(share * n) rows split over the classes by largest remainder."""
    classes = rows.groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()
    wanted = F.ceil(F.round(F.sum("n").over(whole) * F.lit(share), 9))
    exact = F.col("n") * F.col("wanted") / F.sum("n").over(whole)
    base = classes.withColumn("wanted", wanted).withColumn("exact", exact)
    base = base.withColumn("floor", F.floor(F.round("exact", 9)))
    by_rest = Window.orderBy(F.desc(F.round(F.col("exact") - F.col("floor"), 9)), label)
    spare = F.col("wanted") - F.sum("floor").over(whole)
    extra = (F.row_number().over(by_rest) <= spare).cast("long")
    return base.select(label, (F.col("floor") + extra).alias("quota"))


def stratified_sample(
    rows: DataFrame, row_id: str, label: str, share: float = 0.1, seed: int = 42
) -> DataFrame:
    """Exactly the quota of each class, drawn by the order of md5(id-seed).

    Counts per leading hex digits place the cut, and only the slice of hashes around it is ranked,
    so a class of any size is never sorted in one task.
    """
    hashed = rows.withColumn("h", F.md5(F.concat_ws("-", F.col(row_id).cast("string"), F.lit(str(seed)))))
    hashed = hashed.withColumn("slice", F.substring("h", 1, 3))
    before = Window.partitionBy(label).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        hashed.groupBy(label, "slice")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(stratified_quota(rows, label, share), label)
        .withColumn("left", F.col("quota") - F.col("before"))
        .where(F.col("left") > 0)
        .select(label, "slice", "n", "left")
    )
    drawn = hashed.join(broadcast_if_small(cut(slices)), [label, "slice"])
    inside = drawn.where("left >= n").select(*rows.columns)
    in_slice = Window.partitionBy(label, "slice").orderBy("h", row_id)
    edge = drawn.where("left < n").withColumn("rank", F.row_number().over(in_slice))
    return inside.unionByName(edge.where("rank <= left").select(*rows.columns))
