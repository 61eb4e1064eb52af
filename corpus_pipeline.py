"""Documents to packed token windows, stage by stage; each stage works on what the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyglint.llm import decontaminate, line_dedup, near_dedup, packing, quality_model
from polyglint.llm.common import settle, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines met before go; a document whose lines have all been met before goes with them."""
    found = line_dedup.dedup_lines(docs)
    found = found.where((F.col("n_exact") + F.col("n_near") == 0) | (F.btrim("text", F.lit(" \t\r\n\x0b\x0c")) != ""))
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents the one with the smallest id stays."""
    judged = near_dedup.near_duplicates(docs)
    gone = settle(judged.where("not kept").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 1024 ids over all that is left."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality), ("line dedup", lines), ("near dedup", copies),
    ("decontamination", leaks), ("packing", packed),
]

#: The classifier and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
