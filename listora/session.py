"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Results depend on these; they are set on the session that is handed in.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # a repeated JSON key keeps its last value instead of failing the parse
    "spark.sql.variant.allowDuplicateKeys": "true",
    # hot join keys are split even where that costs one more shuffle
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Python gets rows in batches of bounded size, however long their texts are
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # the JVM never compiles methods above 8000 bytes: with this limit Spark
    # splits such a stage up instead (about twice as fast on the wide stages)
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="listora-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/listora/{name}-{uuid.uuid4().hex}"


def write_out(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder.

    A written table survives lost executors, is computed once however often it
    is read, and unlike a checkpoint it is read column by column.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def write_out_with(df: DataFrame, name: str, metric: Column) -> tuple[DataFrame, object]:
    """``write_out`` that also brings back one aggregate, at no extra pass."""
    seen = Observation()
    table = write_out(df.observe(seen, metric.alias("metric")), name)
    return table, seen.get["metric"]


def remove(*tables: DataFrame) -> None:
    """Delete tables of ``write_out`` whose readers are written themselves."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Let shuffle files go that no plan holds any more.

    Spark deletes the shuffle files of a finished query once its plan is collected on the driver, which may be long after
    several large steps have filled the disks; so the collection is asked for between them.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def row_count() -> Column:
    return F.count(F.lit(1))
