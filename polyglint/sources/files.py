"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null

_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_parquet(
    spark: SparkSession, path: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """Parquet pruned to those of the ``keep`` columns that exist."""
    df = spark.read.parquet(path)
    return df if keep is None else df.select(*[c for c in keep if c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with quoted line breaks; empty and blank strings become null."""
    df = spark.read.options(**_CSV).schema(schema).csv(path)
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[blank_to_null(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Add a batch to a table of files; the first batch creates it."""
    df.write.mode("append").parquet(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Each batch is its own set of files, every file with a header the reader skips."""
    df.write.mode("append").options(header="true", quote='"', escape='"').csv(path)


def preview(df: DataFrame, cols: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of chosen columns in an explicit order."""
    return df.orderBy(*order).select(*cols).limit(n)


def read_stopwords(df: DataFrame, limit: int = 20000) -> dict[str, list[str]]:
    """Stopwords by language from a (lang, word) table, for the literal sets of an expression.

    A table of more than ``limit`` rows is refused, as it would all stand in the plan: remove
    those words with ``operators.joins.stopword_antijoin``, which takes the table itself.
    """
    rows = df.select("lang", "word").na.drop().distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"stopword table has more than {limit} rows")
    table: dict[str, list[str]] = {}
    for lang, word in sorted((r.lang, r.word) for r in rows):
        table.setdefault(lang, []).append(word)
    return table
