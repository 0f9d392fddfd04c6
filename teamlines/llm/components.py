"""Connected components of a link table, by spreading the smallest label and jumping to it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.session import materialized


def components(links: DataFrame):
    """``row_id, label`` of every row in ``links (a, b)``; the label is the smallest row of its component.

    Labels are written after each round, so no lineage grows and a lost executor costs one round.
    """
    both = materialized(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = materialized(
        both.groupBy(F.col("a").alias("row_id")).agg(F.min("b").alias("near")).select("row_id", F.least("row_id", "near").alias("label"))
    )
    while True:
        near = both.join(labels.withColumnsRenamed({"row_id": "b", "label": "l"}), "b").groupBy("a").agg(F.min("l").alias("near"))
        spread = materialized(
            labels.join(near.withColumnRenamed("a", "row_id"), "row_id")
            .select("row_id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        )
        ahead = spread.select(F.col("row_id").alias("label"), F.col("label").alias("next"))
        moved = materialized(
            spread.join(ahead, "label").select("row_id", F.least("label", "next").alias("label"), "old")
        )
        if moved.where("label <> old").isEmpty():
            return moved.select("row_id", "label")
        labels = moved.select("row_id", "label")
