"""The latest row of each id, kept up to date on a stream.

An id's row so far is the state of an aggregation; a batch sends on only the ids
whose row it has changed. The changes of each batch are a folder of their own,
written over if the batch is taken again, so a restarted stream neither loses nor
doubles any. Rows without an id need no state: they pass through a stream of
their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listora.operators.identity import has_id
from listora.schema import ROW_ID, TIMESTAMP_COLUMN
from listora.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_BATCH = "_batch"


def _recency(columns) -> Column:
    """Greater is newer: dated before undated rows, then by time, then the lower row id."""
    at = F.col(TIMESTAMP_COLUMN) if TIMESTAMP_COLUMN in columns else F.lit(None).cast("timestamp")
    return F.struct(at.isNotNull().alias("dated"), at.alias("at"), (-F.col(ROW_ID)).alias("first"))


def changed_latest(stream: DataFrame, id_column: str) -> DataFrame:
    """The rows with an id, reduced to the newest of each, for output in update mode.

    `max_by` is also taken within each task before the shuffle, so a hot id sends
    one row from each task, and the state holds one row an id.
    """
    columns = stream.columns
    rows = stream.filter(has_id(id_column, columns))
    newest = F.max_by(F.struct(*columns), _recency(columns)).alias("_row")
    return rows.groupBy(F.col(id_column).alias("_id")).agg(newest).select("_row.*")


@dataclass(frozen=True)
class LatestTable:
    """Where the changes, the rows without id and the progress of both streams are kept."""

    folder: str
    id_column: str

    @classmethod
    def in_scratch(cls, spark: SparkSession, id_column: str) -> LatestTable:
        return cls(scratch_path(spark, "latest"), id_column)

    def _schema(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*(T.StructField(f.name, f.dataType) for f in schema), T.StructField(_BATCH, T.LongType())])

    def take(self, stream: DataFrame) -> None:
        """Take up all there is to take, in batches.

        The state lies in RocksDB unless the session names another provider, so it
        is bounded by the disks of the executors and not by their memory.
        """
        spark = stream.sparkSession
        # there is a table to read even where no batch has come
        spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{self.folder}/changes/{_BATCH}=-1")
        provider = spark.conf.get(_PROVIDER)
        if provider.endswith("HDFSBackedStateStoreProvider"):
            spark.conf.set(_PROVIDER, ROCKSDB)
        try:
            updates = (
                changed_latest(stream, self.id_column)
                .writeStream.outputMode("update")
                .foreachBatch(self._write_changes)
                .option("checkpointLocation", f"{self.folder}/progress-changes")
                .trigger(availableNow=True)
                .start()
            )
            updates.awaitTermination()
        finally:
            spark.conf.set(_PROVIDER, provider)
        plain = (
            stream.filter(~has_id(self.id_column, stream.columns))
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{self.folder}/without-id")
            .option("checkpointLocation", f"{self.folder}/progress-without-id")
            .trigger(availableNow=True)
            .start()
        )
        plain.awaitTermination()

    def _write_changes(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/changes/{_BATCH}={number}")

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The table as of the last batch: of each id the row its latest change left, and all rows without id."""
        changes = spark.read.schema(self._schema(schema)).parquet(f"{self.folder}/changes")
        last = Window.partitionBy(self.id_column).orderBy(F.desc(_BATCH))
        current = changes.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank", _BATCH)
        return current.unionByName(spark.read.schema(schema).parquet(f"{self.folder}/without-id"))


def drain_latest(stream: DataFrame, id_column: str, table: LatestTable | None = None) -> DataFrame:
    """All there is on the stream, reduced like `identity.latest_per_id` does a table.

    With the same `table` a later call goes on from the state the last one left.
    """
    table = table or LatestTable.in_scratch(stream.sparkSession, id_column)
    table.take(stream)
    return table.read(stream.sparkSession, stream.schema)
