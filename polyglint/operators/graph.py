"""Tag co-occurrence graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .aggregates import token_frequency


def tag_nodes(df: DataFrame, tags: Column, k: int = 150) -> DataFrame:
    """The k most frequent tags."""
    return token_frequency(df, tags, k)


def cooccurrence(df: DataFrame, tags: Column, nodes: DataFrame) -> DataFrame:
    """(source, target, weight): rows on which both tags appear, source < target.

    Each task adds its rows up in one k x k matrix and hands on only the non-zero cells, so
    what is shuffled does not grow with the rows or with the tags per row.
    """
    nodes = cut_lineage(nodes)
    k = nodes.count()
    known = nodes.agg(F.array_sort(F.collect_list("token"))).scalar()
    carried = df.select(tags.alias("_tags"), known.alias("_known")).withColumn(
        "_present", F.array_intersect(F.array_distinct("_tags"), "_known")
    )
    marks = carried.where(F.size("_present") > 1).select(
        F.transform("_present", lambda w: F.array_position("_known", w).cast("int") - 1).alias("at")
    )

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k, k), dtype=np.int64)
        for batch in batches:
            rows = np.zeros((len(batch), k), dtype=np.float64)
            if len(batch):
                each = batch["at"].map(len).to_numpy()
                rows[np.repeat(np.arange(len(batch)), each), np.concatenate(batch["at"].to_numpy())] = 1.0
            total += np.rint(rows.T @ rows).astype(np.int64)
        i, j = np.nonzero(np.triu(total, 1))
        yield pd.DataFrame({"i": i, "j": j, "n": total[i, j]})

    partial = marks.mapInPandas(add_up, "i int, j int, n long")
    return partial.groupBy("i", "j").agg(F.sum("n").alias("weight")).select(
        F.element_at(known, F.col("i") + 1).alias("source"),
        F.element_at(known, F.col("j") + 1).alias("target"), "weight",
    )


def both_ways(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight")
    return edges.select("source", "target", "weight").unionByName(back)


def degree_centrality(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Degree over n - 1 for every node, isolated ones included."""
    degrees = both_ways(edges).groupBy("source").agg(F.count(F.lit(1)).alias("degree"))
    n = nodes.agg(F.count(F.lit(1))).scalar()
    joined = nodes.select("token").join(degrees, F.col("token") == F.col("source"), "left")
    degree = F.coalesce("degree", F.lit(0).cast("bigint"))
    return joined.select(
        "token", degree.alias("degree"),
        F.when(n > 1, degree / (n - 1)).otherwise(F.lit(0.0)).alias("centrality"),
    )


def communities(edges: DataFrame, rounds: int = 6) -> DataFrame:
    """(token, community) by weighted label propagation, ties to the smallest label.

    A node keeps its own label with half its strongest link's weight, which stops the
    flipping that plain synchronous updates fall into.
    """
    links = cut_lineage(both_ways(edges))
    own = links.groupBy("source").agg((F.max("weight") / 2).alias("pull"))
    labels = own.select(F.col("source").alias("token"), F.col("source").alias("community"))
    for _ in range(rounds):
        votes = links.join(labels, F.col("target") == F.col("token")).select(
            "source", "community", F.col("weight").cast("double").alias("weight")
        )
        stay = own.join(labels, F.col("source") == F.col("token")).select(
            "source", "community", F.col("pull").alias("weight")
        )
        tally = votes.unionByName(stay).groupBy("source", "community").agg(F.sum("weight").alias("w"))
        best = F.min_by("community", F.struct((-F.col("w")).alias("w"), "community"))
        labels = cut_lineage(
            tally.groupBy(F.col("source").alias("token")).agg(best.alias("community"))
        )
    return labels


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Weighted modularity of a partition given as (token, community), as one row."""
    links = both_ways(edges)
    a = labels.select(F.col("token").alias("source"), F.col("community").alias("_a"))
    b = labels.select(F.col("token").alias("target"), F.col("community").alias("_b"))
    per = (
        links.join(a, "source").join(b, "target")
        .groupBy(F.col("_a").alias("community"))
        .agg(
            F.sum("weight").alias("strength"),
            F.sum(F.when(F.col("_a") == F.col("_b"), F.col("weight")).otherwise(0)).alias("inside"),
        )
    )
    total = per.agg(F.sum("strength")).scalar()
    share = F.col("strength") / total
    return per.agg(
        F.sum(F.col("inside") / total - share * share).alias("modularity"),
        F.count(F.lit(1)).alias("communities"),
    )


def rank_nodes(centrality: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.orderBy(F.desc("centrality"), "token"))
    return centrality.orderBy(F.desc("centrality"), "token").limit(k).withColumn("rank", place)
