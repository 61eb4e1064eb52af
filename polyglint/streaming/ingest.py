"""Incremental ingest with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import guarded_ratio, to_count, weekday_number


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 64
) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def new_rows(stream: DataFrame, id_col: str, moment: str, late: str) -> DataFrame:
    """Each id once within the lateness window.

    Rows that arrive more than ``late`` behind the newest moment are lost, and an id may come
    again after that time: state older than the watermark is dropped. ``land_new_rows`` loses
    nothing, at the price of reading the landed ids.
    """
    timed = stream.withColumn(moment, F.col(moment).cast("timestamp"))
    valid = timed.where(F.col(id_col).isNotNull())
    return valid.withWatermark(moment, late).dropDuplicatesWithinWatermark([id_col])


def derive_events(stream: DataFrame) -> DataFrame:
    """Parse the JSON properties and derive the time and ratio columns of a record."""
    k = to_count(F.get_json_object("props", "$.k"))
    return stream.select(
        "event_id", "user_id", "event_type", "ts", "value", k.alias("k"),
        F.hour("ts").alias("upload_hour"), weekday_number(F.col("ts")).alias("upload_day_of_week"),
        guarded_ratio(F.col("value"), k.cast("double")).alias("value_ratio"),
    )


def with_attributes(stream: DataFrame, dim: DataFrame, stream_key: str, dim_key: str) -> DataFrame:
    """Stream-static left join; the static side is read afresh for every batch."""
    return stream.join(dim, F.col(stream_key) == F.col(dim_key), "left")


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything that has arrived, append it as Parquet and stop. Offsets and state
    live under ``checkpoint``, so a rerun continues where the last one ended."""
    run = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()


def land_new_rows(
    stream: DataFrame, id_col: str, path: str, checkpoint: str
) -> None:
    """Append only ids that no earlier batch or run has landed, whatever their age.

    A partition of the landed table is one batch of one run; a run is what its checkpoint names,
    so a new checkpoint never touches what another one landed. Each micro-batch is deduplicated
    and anti-joined with all other partitions. A replayed batch replaces its own partition
    alone, so a lost executor or driver neither doubles rows nor loses any.
    """

    def land(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        named = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id"))
        own = named.first()[0]
        fresh = batch.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
        try:
            landed = spark.read.parquet(path)
        except Exception as err:  # nothing has landed yet
            if "PATH_NOT_FOUND" not in str(err):
                raise
        else:
            landed = landed.where((F.col("_run") != own) | (F.col("_batch") != number))
            fresh = fresh.join(landed.select(id_col), id_col, "left_anti")
        fresh = fresh.withColumn("_run", F.lit(own)).withColumn("_batch", F.lit(number))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "_run", "_batch"
        ).parquet(path)

    run = (
        stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
