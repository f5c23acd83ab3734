"""Incremental ingest: the row-wise stages on a file stream.

Normalising, cleaning and enriching keep no state, so the batch functions run
on a stream unchanged and the drained result equals the batch result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from listora.session import prepare, scratch_path
from listora.sources.files import CSV_OPTIONS, text_schema


def stream_parquet(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    return (
        prepare(spark)
        .readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def stream_csv(
    spark: SparkSession, folder: str, headers: list[str], pattern: str = "*.csv",
    files_per_batch: int = 1000,
) -> DataFrame:
    return (
        prepare(spark)
        .readStream.schema(text_schema(headers))
        .options(**CSV_OPTIONS, multiLine=True)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def drain(stream: DataFrame, table: str | None = None, progress: str | None = None) -> DataFrame:
    """Process everything there is, in batches, into a Parquet table.

    With the same ``progress`` folder a later call takes up only new files.
    """
    spark = stream.sparkSession
    table = table or scratch_path(spark, "stream-table")
    progress = progress or scratch_path(spark, "stream-progress")
    query = (
        stream.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", progress)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(table)
