"""Mini-batch k-means: centres that move with every batch, by steps that shrink as they gather rows.

Rows are dealt into batches by a seeded hash of their id and written by batch, so each is read once. The first batch is
clustered as a whole. In every later one each centre moves to the mean of all rows it has taken so far, which is the
per-centre step of Sculley (WWW 2010) for all rows of a batch at once: new = old + (mean - old) * n / (weight + n).
Centres and their weights stay a table; the same step updates centres from a stream's batches.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listora.operators.nearest import assign_nearest
from listora.session import row_count, scratch_path, write_out

BATCHES = 10


def updated_centres(centres: DataFrame, rows: DataFrame, vector: str) -> DataFrame:
    """(cluster_id, centroid, weight) after a batch of rows; for centres that take none nothing changes.

    Works on any batch, so it also serves a stream's ``foreachBatch``: keep the result as a table and hand it in again.
    Sums are taken by centre and dimension, in each task before the shuffle.
    """
    found = assign_nearest(rows.select(F.col(vector).alias("_vector")), "_vector", centres.select("cluster_id", "centroid"))
    near = found.filter(F.col("cluster_id").isNotNull())
    cells = near.select("cluster_id", F.posexplode("_vector").alias("dim", "value"))
    sums = cells.groupBy("cluster_id", "dim").agg(F.sum("value").alias("sum"), row_count().alias("n"))
    taken = sums.groupBy("cluster_id").agg(
        F.sort_array(F.collect_list(F.struct("dim", "sum"))).getField("sum").alias("sums"), F.max("n").alias("n")
    )
    moved = F.zip_with(
        "centroid", "sums", lambda old, total: old + (total - old * F.col("n")) / (F.col("weight") + F.col("n"))
    )
    return write_out(
        centres.join(taken, "cluster_id", "left").select(
            "cluster_id",
            F.when(F.col("n").isNull(), F.col("centroid")).otherwise(moved).alias("centroid"),
            (F.col("weight") + F.coalesce("n", F.lit(0))).alias("weight"),
        ),
        "moved-centres",
    )


def fit_mini_batch(
    rows: DataFrame, row_id: str, vector: str, k: int, seed: int = 42, batches: int = BATCHES, max_iterations: int = 20
) -> DataFrame:
    """(cluster_id, centroid, weight): centres of all rows, each read once but for the first batch's own iterations.

    Rows without a vector are left out. Batches depend on ids and seed only. An empty first batch raises.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "batches")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.select(F.col(row_id).alias("_id"), F.col(vector).cast("array<double>").alias("_vector"))
        .filter(F.col("_vector").isNotNull())
        .withColumn("_batch", F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(batches)).cast("int"))
        .repartition(parts, "_batch", F.pmod(F.xxhash64("_id"), F.lit(parts)))
        .write.partitionBy("_batch")
        .parquet(path)
    )
    table = spark.read.schema("_id long, _vector array<double>, _batch int").parquet(path)
    first = table.filter("_batch = 0")
    in_order = first.select("_id", array_to_vector("_vector").alias("features")).repartition(parts, "_id").sortWithinPartitions("_id")
    model = KMeans(k=k, seed=seed, maxIter=max_iterations, initMode="k-means||").fit(in_order.select("features"))
    start = [(i, centre.tolist(), 0) for i, centre in enumerate(model.clusterCenters())]
    centres = spark.createDataFrame(start, "cluster_id long, centroid array<double>, weight long")
    for number in range(batches):  # the first batch gives its centres their weights
        centres = updated_centres(centres, table.filter(F.col("_batch") == number), "_vector")
    return centres
