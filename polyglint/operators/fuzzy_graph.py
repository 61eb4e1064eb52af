"""Neighbour lists to an undirected graph of membership weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

#: Halvings of the bandwidth's bracket, and the least bandwidth as a share of the mean distance.
HALVINGS, LEAST_SHARE = 50, 1e-3


def _memberships(excess: Column, width: Column) -> Column:
    """exp(-excess / width) of each distance beyond the nearest; 1 where there is no excess."""
    return F.transform(excess, lambda e: F.when(e <= 0, F.lit(1.0)).otherwise(F.exp(-e / F.nullif(width, F.lit(0.0)))))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _bandwidth(excess: Column, mean: Column) -> Column:
    """The width at which the memberships add up to log2 of their number.

    At max(excess) / ln(n / log2 n) each is log2(n) / n or more, so the width lies below that;
    the bracket is halved in place. Rows with too many distances at the nearest have no such
    width and get the least one.
    """
    n = F.size(excess).cast("double")
    wanted = F.log2(n)
    top = F.when(wanted > 0, F.array_max(excess) / F.log(n / F.nullif(wanted, F.lit(0.0)))).otherwise(F.lit(0.0))

    def halve(bracket: Column, _: Column) -> Column:
        middle = (bracket["low"] + bracket["high"]) / 2
        over = _total(F.coalesce(_memberships(excess, middle), F.array().cast("array<double>"))) > wanted
        return F.struct(
            F.when(over, bracket["low"]).otherwise(middle).alias("low"),
            F.when(over, middle).otherwise(bracket["high"]).alias("high"),
        )

    start = F.struct(F.lit(0.0).alias("low"), top.alias("high"))
    steps = F.sequence(F.lit(1), F.lit(HALVINGS))
    found = F.aggregate(steps, start, halve, lambda b: (b["low"] + b["high"]) / 2)
    return F.greatest(found, LEAST_SHARE * mean)


def directed_memberships(edges: DataFrame) -> DataFrame:
    """(id, neighbour, membership) of neighbour lists (id, neighbour, similarity).

    The distance is 1 - similarity, at least 0. Each row has a scale of its own: its nearest
    neighbour that isn't at distance 0 has membership 1, as all nearer ones, and the
    rest fall off by a bandwidth at which they add up to log2 of the list's length. Lists are
    bounded by the k of the graph, so a row's list is handled in place. Links to itself and
    rows with a null are left out; a repeated link counts by its largest similarity.
    """
    distance = F.greatest(1 - F.max("similarity").cast("double"), F.lit(0.0)).alias("d")
    links = edges.where("id <> neighbour and similarity is not null").groupBy("id", "neighbour").agg(distance)
    lists = links.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("d", "neighbour"))).alias("links"))
    apart = F.filter(F.col("links")["d"], lambda d: d > 0)
    nearest = F.coalesce(F.array_min(apart), F.lit(0.0))
    excess = let(nearest, lambda r: F.transform(F.col("links")["d"], lambda d: F.greatest(d - r, F.lit(0.0))))
    lists = lists.withColumn("excess", excess).withColumn("mean", _total(F.col("links")["d"]) / F.size("links"))
    weights = let(_bandwidth(F.col("excess"), F.col("mean")), lambda w: _memberships(F.col("excess"), w))
    pairs = F.explode(F.arrays_zip(F.col("links")["neighbour"].alias("neighbour"), weights.alias("membership")))
    return lists.select("id", pairs.alias("p")).select("id", "p.neighbour", "p.membership")


def fuzzy_union(directed: DataFrame) -> DataFrame:
    """(source, target, weight), source < target: a + b - ab of the memberships both ways, of
    which a missing one counts 0. A pair has at most two rows, so one shuffle by pair does."""
    pair = [F.least("id", "neighbour").alias("source"), F.greatest("id", "neighbour").alias("target")]
    both = F.when(F.count("membership") > 1, F.max("membership") * F.min("membership")).otherwise(F.lit(0.0))
    return directed.groupBy(*pair).agg((F.sum("membership") - both).alias("weight"))


def fuzzy_graph(edges: DataFrame) -> DataFrame:
    """Weights from 0 to 1 of the undirected graph of neighbour lists (id, neighbour, similarity)."""
    return fuzzy_union(directed_memberships(edges))
