"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_ink

ALL = "ALL"


def keep_nonblank(df: DataFrame, text: str) -> DataFrame:
    return df.where(has_ink(F.col(text)))


def keep_min_tokens(df: DataFrame, count_col: str, minimum: int = 2) -> DataFrame:
    return df.where(F.col(count_col) >= minimum)


def min_tokens_report(df: DataFrame, count_col: str, minimum: int = 2) -> DataFrame:
    """One row: rows before, kept and removed by ``keep_min_tokens``."""
    kept = F.count_if(F.col(count_col) >= minimum)
    return df.agg(
        F.count(F.lit(1)).alias("before"),
        kept.alias("kept"),
        (F.count(F.lit(1)) - kept).alias("removed"),
    )


def between(df: DataFrame, col: str, low, high) -> DataFrame:
    """Inclusive range; nulls are excluded."""
    return df.where(F.col(col).between(low, high))


def facet_condition(
    equal: Mapping[str, object] | None = None,
    one_of: Mapping[str, Sequence] | None = None,
    ranges: Mapping[str, tuple] | None = None,
) -> Column:
    """Conjunction of the active facets; ``"ALL"``, alone or inside a list, lifts a facet."""
    condition = F.lit(True)
    for col, wanted in (equal or {}).items():
        if wanted != ALL:
            condition = condition & (F.col(col) == wanted)
    for col, wanted in (one_of or {}).items():
        if wanted and ALL not in wanted:
            condition = condition & F.col(col).isin(list(wanted))
    for col, (low, high) in (ranges or {}).items():
        condition = condition & F.col(col).between(low, high)
    return condition


def facet_filter(df: DataFrame, **facets) -> DataFrame:
    """Rows that satisfy every facet; see ``facet_condition``."""
    return df.where(facet_condition(**facets))


def drop_missing(df: DataFrame, *cols: str) -> DataFrame:
    return df.na.drop(subset=list(cols))


def first_seen(df: DataFrame, ids: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row of every valid id; rows with a null id are dropped.

    An aggregate rather than a window: repeats of a hot id collapse before the shuffle.
    """
    valid = df.na.drop(subset=list(ids))
    key = ids[0]
    rest = [c for c in df.columns if c != key]
    earliest = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return valid.groupBy(key).agg(earliest).select(
        *[F.col(key) if c == key else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    )


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def emptiness(df: DataFrame) -> DataFrame:
    """One row telling whether the selection holds no data."""
    n = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return n.select((F.col("n") == 0).alias("no_data"))
