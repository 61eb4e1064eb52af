"""Sorted reports, growth and ranks. Global windows only ever see aggregated or limited rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def growth(counts: DataFrame, period: str, value: str = "count", out: str = "growth") -> DataFrame:
    """Percent change against the previous period present; null for the first.

    ``counts`` must be aggregated to one row per period.
    """
    before = F.lag(value).over(W.orderBy(period))
    return counts.withColumn(out, F.when(before != 0, (F.col(value) / before - 1) * 100))


def top_rows(df: DataFrame, metric: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k rows with the largest metric."""
    return df.orderBy(F.desc_nulls_last(metric), *tie).limit(k)


def leaderboard(
    results: DataFrame, metric: str = "f1", tie: Sequence[str] = ("embedding", "model"),
    k: int | None = None,
) -> DataFrame:
    """All results with their rank by metric, best first; with ``k`` a report of the best k.

    Results are a table of scores, one row per experiment, and are ranked in one task.
    """
    best = results if k is None else top_rows(results, metric, k, tie)
    place = F.row_number().over(W.orderBy(F.desc_nulls_last(metric), *tie))
    return best.withColumn("rank", place)


def best_per_group(
    df: DataFrame, group: Sequence[str], metric: str, tie: Sequence[str]
) -> DataFrame:
    """The row with the largest metric in every group, as a combinable aggregate."""
    keys = list(group)
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*rest), F.struct((-F.col(metric)).alias("_m"), *tie)).alias("_row")
    found = df.where(F.col(metric).isNotNull()).groupBy(*keys).agg(row)
    return found.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)
