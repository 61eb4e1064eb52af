"""Join-shaped operators. Broadcast hints appear only where the row count is bounded by k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import group_counts, top_groups


def lookup_left(
    facts: DataFrame, dim: DataFrame, on: str, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Left join; missing attributes take their defaults.

    No hint: small dimensions are broadcast by size, large ones are sort-merged, and adaptive
    execution splits a hot key of the facts side.
    """
    joined = facts.join(dim, on, "left")
    for col, value in (defaults or {}).items():
        joined = joined.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    return joined


def keep_top_groups(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows of the k most frequent groups."""
    return df.join(F.broadcast(top_groups(df, key, k).select(key)), key, "left_semi")


def remove_seen(batch: DataFrame, landed: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id has not landed yet."""
    return batch.join(landed.select(id_col).na.drop(), id_col, "left_anti")


def decode_labels(df: DataFrame, index: str, table: DataFrame, name: str) -> DataFrame:
    """Add the label name of an index column; ``table`` holds (index, name)."""
    return df.join(table.select(index, name), index, "left")


def by_group_size(table: DataFrame, df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows of a per-group ``table`` for the k largest groups of ``df``, largest first."""
    tops = top_groups(df, key, k, name="group_size")
    return table.join(F.broadcast(tops), key).orderBy(F.desc("group_size"), key)


def stopword_antijoin(
    df: DataFrame, tokens: Column, lang: str, id_col: str, stopwords: DataFrame
) -> DataFrame:
    """Long (id, position, token) form without stopwords, for word lists kept as a table.

    ``stopwords`` holds (lang, word). English words apply to every row; both rules are one
    anti join on the token with the language compared inside it.
    """
    words = stopwords.select(F.col("lang").alias("_lang"), F.col("word").alias("_word")).distinct()
    long = df.select(id_col, F.col(lang).alias("_row_lang"), F.posexplode(tokens).alias("position", "token"))
    english = words.where(F.col("_lang") == "en").select("_word")
    own = words.where(F.col("_lang") != "en")
    left = long.where(F.length("token") > 1).join(english, F.col("token") == F.col("_word"), "left_anti")
    return left.join(
        own,
        (F.col("token") == F.col("_word")) & (F.col("_row_lang") == F.col("_lang")),
        "left_anti",
    ).select(id_col, "position", "token")


def union_blocks(blocks: Sequence[DataFrame]) -> DataFrame:
    """Stack result blocks by column name."""
    first, *rest = blocks
    for block in rest:
        first = first.unionByName(block)
    return first


def shared_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def group_size(df: DataFrame, key: str) -> DataFrame:
    return group_counts(df, key, name="group_size")
