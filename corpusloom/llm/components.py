"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize


def components(links: DataFrame, left: str = "x", right: str = "y") -> DataFrame:
    """``node`` and ``component``, its smallest reachable id, for every id of ``links``. Links with a null id count for nothing.

    Each round gives a node the smallest label among itself and its neighbours, and then that label's own
    label, so labels travel twice as far each round. A round is written to the shared folder; the
    rounds end when no label changes. A node with many links is combined per task before it is shuffled.
    """
    both = links.select(F.col(left).cast("long").alias("node"), F.col(right).cast("long").alias("other")).filter("node is not null and other is not null and node <> other")
    edges = materialize(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    labels = materialize(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("component", "near").alias("next"), "component")
        ends = labels.select(F.col("node").alias("next"), F.col("component").alias("end"))
        moved = materialize(lower.join(ends, "next", "left").select("node", F.least("next", F.coalesce("end", "next")).alias("component"), F.col("component").alias("was")), "labels")
        if moved.filter("component <> was").isEmpty():
            return moved.select("node", "component")
        labels = moved.select("node", "component")
