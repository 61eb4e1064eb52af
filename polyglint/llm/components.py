"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(edges: DataFrame) -> DataFrame:
    """``id, component``: the smallest id reachable, for every id in ``edges`` (``a, b``).

    Each round takes the least label among neighbours, hangs the old label's vertex on it and
    follows labels of labels, so chains shrink by doubling. A round is written to the shared
    folder, so no lineage grows. Loops, repeated edges and both directions are fine.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = settle(both, "edges")
    labels = settle(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component")).withColumnRenamed("a", "id"), "labels")
    while True:
        label = labels.select(F.col("id").alias("b"), F.col("component").alias("theirs"))
        offered = both.join(label, "b").groupBy("a").agg(F.min("theirs").alias("offer")).withColumnRenamed("a", "id")
        offered = labels.join(offered, "id").select("id", "component", F.least("component", "offer").alias("offer"))
        # a vertex and the vertex its label names take the same offer
        hung = offered.select("id", "offer").union(offered.select(F.col("component").alias("id"), "offer"))
        hung = hung.groupBy("id").agg(F.min("offer").alias("offer"))
        up = labels.select(F.col("id").alias("offer"), F.col("component").alias("above"))
        found = hung.join(up, "offer").select("id", F.least("offer", "above").alias("component"))
        found = settle(found, "labels")
        before = labels.select("id", F.col("component").alias("was"))
        moved = not found.join(before, "id").where("component <> was").isEmpty()
        labels = found
        if not moved:
            return labels
