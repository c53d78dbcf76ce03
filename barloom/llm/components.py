"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node with a link; label is the smallest node reachable.

    Rounds of taking the smallest label among neighbours and then the label of one's label, so
    chains shorten by halves. Labels are written each round; only the number of changes comes to
    the driver. Joins are by key alone and followed by partial aggregation, so a node with very
    many links is split by skew handling. Null ends are dropped; an empty graph gives no rows.
    """
    links = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    both = cut_lineage(
        links.select(F.col(a).alias("node"), F.col(b).alias("other"))
        .union(links.select(F.col(b).alias("node"), F.col(a).alias("other")))
        .distinct()
    )
    labels = cut_lineage(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other")
            .groupBy("node")
            .agg(F.min("near").alias("near"))
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        new = cut_lineage(
            labels.join(near, "node")
            .join(jump, "label")
            .select("node", F.least("label", "near", "jump").alias("label"), (F.least("near", "jump") < F.col("label")).alias("moved"))
        )
        moved = new.filter("moved").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels
