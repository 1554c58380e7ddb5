"""Connected components over links between integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``id, label`` of every id in ``links`` (a, b): the least id it is linked to.

    Labels spread to neighbours and then jump to their own label's label, until
    none changes; every step is a join and a grouped minimum, cut in the shared
    checkpoint folder, so neither a large component nor a much-linked id gathers
    in one task or on the driver."""
    edges = cut_lineage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = cut_lineage(labels)
    while True:
        near = (edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("seen")))
        spread = cut_lineage(labels.join(near, "id").select("id", F.least("label", "seen").alias("label"), F.col("label").alias("old")))
        jump = spread.select(F.col("id").alias("label"), F.col("label").alias("beyond"))
        jumped = cut_lineage(spread.join(jump, "label", "left").select("id", F.least("label", "beyond").alias("label"), "old"))
        labels = jumped.select("id", "label")
        if jumped.where(F.col("label") != F.col("old")).isEmpty():
            return labels
