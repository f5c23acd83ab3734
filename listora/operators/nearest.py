"""Nearest centre of each row, by matrix products of blocks.

Where all centres together are small, they are one block that goes to every task with
the function, and each block of rows meets it once, all columns of its rows in hand:
no row is shuffled, sorted or joined back, and a task has one Python worker. Else rows
are packed into blocks and centres cut into blocks of one norm range, which each block
of rows meets by a shuffle over block numbers, and a row's winners of the blocks are
reduced to the nearest. Within a pair, centres
are taken in slices, nearest norms first, and a row skips a slice whose norms lie
further from its own than its nearest centre so far: by the triangle inequality
none of it can be nearer. The lowest id wins a tie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listora.session import row_count, write_out, write_out_with

BLOCK_BYTES = 4 << 20  # of vectors in a block of rows or centres
BROADCAST_BYTES = 16 << 20  # of all centres: above it they are shuffled
SLICE = 128  # centres looked at together
_CLOSE = 1e-9  # products are this exact, relative to the norms; what is closer is measured anew


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _row_blocks(rows_in_block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), rows_in_block):
                part = batch.slice(low, rows_in_block)
                ids = part.column("_row").to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.tobytes()], pa.binary()), pa.array([_matrix(part.column("_vector")).tobytes()], pa.binary()), pa.array([int(ids[0])])],
                    names=["ids", "vectors", "first"],
                )

    return run


def _best_of(rows: np.ndarray, ids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre and squared distance of each row; centres are ordered by norm."""
    norms, row_norms = np.linalg.norm(centres, axis=1), np.linalg.norm(rows, axis=1)
    squares = row_norms**2
    best = np.full(len(rows), np.inf)
    found = np.full(len(rows), -1, np.int64)
    starts = np.arange(0, len(centres), SLICE)
    middle = float(np.median(row_norms))
    away = [max(norms[s] - middle, middle - norms[min(s + SLICE, len(centres)) - 1], 0.0) for s in starts]
    for s in starts[np.argsort(away, kind="stable")]:
        part = centres[s : s + SLICE]
        low, high = norms[s], norms[min(s + SLICE, len(centres)) - 1]
        bound = np.maximum(np.maximum(low - row_norms, row_norms - high), 0.0)
        slack = _CLOSE * (row_norms + high) ** 2
        left = np.flatnonzero(bound**2 <= best + slack)
        if not len(left):
            continue
        about = squares[left, None] - 2.0 * rows[left] @ part.T + (norms[s : s + SLICE] ** 2)[None, :]
        near = about <= np.minimum(about.min(axis=1), best[left])[:, None] + 2 * slack[left, None]
        at, which = np.nonzero(near)
        exact = ((rows[left[at]] - part[which]) ** 2).sum(axis=1)
        names = ids[s + which]
        order = np.lexsort((names, exact, at))
        first = order[np.concatenate(([True], at[order][1:] != at[order][:-1]))] if len(order) else order
        row, distance, name = left[at[first]], exact[first], names[first]
        better = (distance < best[row]) | ((distance == best[row]) & (name < found[row]))
        best[row[better]], found[row[better]] = distance[better], name[better]
    return found, best


def _winners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            pair = batch.slice(i, 1)
            row_ids = np.frombuffer(pair.column("ids")[0].as_buffer(), np.int64)
            rows = np.frombuffer(pair.column("vectors")[0].as_buffer(), np.float64).reshape(len(row_ids), -1)
            found, best = _best_of(rows, *_centres(pair))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row_ids), pa.array(found), pa.array(best)], names=["_row", "cluster_id", "distance2"]
            )


def _centres(pair: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = pair.column("centre_ids").flatten().to_numpy()
    flat = pair.column("centres").flatten().to_numpy()
    return ids, flat.reshape(len(ids), len(flat) // max(len(ids), 1))


def _usable(vectors: pa.Array, width: int) -> np.ndarray:
    """Which vectors have the centres' size and no null."""
    usable = pc.fill_null(pc.equal(pc.list_value_length(vectors), width), False).to_numpy(zero_copy_only=False)
    values = vectors.flatten()
    if values.null_count:
        usable = usable.copy()
        usable[pc.list_parent_indices(vectors).filter(pc.is_null(values)).to_numpy()] = False
    return usable


def _rows_with_nearest(vector: str, rows_in_block: int, ids: np.ndarray, centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), rows_in_block):
                rows = batch.slice(low, rows_in_block)
                usable = _usable(rows.column(vector), centres.shape[1]) if len(ids) else np.zeros(len(rows), bool)
                found, best = np.zeros(len(rows), np.int64), np.zeros(len(rows))
                if usable.any():
                    found[usable], best[usable] = _best_of(_matrix(rows.column(vector).filter(pa.array(usable))), ids, centres)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(found, mask=~usable), pa.array(best, mask=~usable)],
                    names=[*rows.schema.names, "cluster_id", "distance2"],
                )

    return run


def _points(centers: DataFrame) -> tuple[DataFrame, int, int]:
    """The usable centres, written out, with their number and size."""
    points = centers.select(
        F.col("cluster_id").cast("long").alias("cluster_id"), F.col("centroid").cast("array<double>").alias("centroid")
    ).filter(F.col("centroid").isNotNull() & ~F.exists("centroid", lambda x: x.isNull()))
    points, told = write_out_with(
        points.withColumn("_norm", F.aggregate("centroid", F.lit(0.0), lambda total, x: total + x * x)),
        "centres", F.struct(row_count().alias("n"), F.max(F.size("centroid")).alias("width")),
    )
    return points, told["n"], max(told["width"] or 1, 1)


def _in_norm_order() -> list:
    every = F.sort_array(F.collect_list(F.struct("_norm", "cluster_id", "centroid")))
    return [every.getField("cluster_id").alias("centre_ids"), F.flatten(every.getField("centroid")).alias("centres")]


def _one_block(points: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and centres in the order of `_in_norm_order`, of at most BROADCAST_BYTES."""
    table = points.toArrow().combine_chunks()
    ids, norms = table.column("cluster_id").to_numpy(), table.column("_norm").to_numpy()
    order = np.lexsort((ids, norms))
    centres = np.array(table.column("centroid").to_pylist(), np.float64).reshape(len(ids), -1) if len(ids) else np.empty((0, 1))
    return ids[order], centres[order]


def _nearest_of_many(rows: DataFrame, vector: str, points: DataFrame, count: int, width: int) -> DataFrame:
    """(_row, cluster_id, distance2) of the written table `rows`, whose `_row` is unique, by a shuffle.

    Rows whose vector is null, holds null or is of another size than the centres are left out.
    """
    in_block = max(1, BLOCK_BYTES // (8 * width))
    n_blocks = max(1, -(-count // in_block))
    # blocks of one norm range; their borders come from a sample and need not be even
    dealt = points.repartitionByRange(n_blocks, "_norm", "cluster_id") if n_blocks > 1 else points.coalesce(1)
    blocks = write_out(
        dealt.withColumn("part", F.spark_partition_id()).groupBy("part").agg(*_in_norm_order()), "centre-blocks"
    )
    given = rows.select("_row", F.col(vector).cast("array<double>").alias("_vector")).filter(
        (F.size("_vector") == width) & ~F.exists("_vector", lambda x: x.isNull())
    )
    packed = given.mapInArrow(_row_blocks(in_block), "ids binary, vectors binary, first long")
    packed = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    # copies of the centres for as many tasks as share a block
    copies = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    pairs = packed.withColumn("salt", F.pmod(F.xxhash64("first"), F.lit(copies)).cast("int")).join(salted, ["part", "salt"])
    won = pairs.select("ids", "vectors", "centre_ids", "centres").mapInArrow(
        _winners, "_row long, cluster_id long, distance2 double"
    )
    if n_blocks == 1:
        return won
    best = F.min(F.struct("distance2", "cluster_id")).alias("best")
    return won.groupBy("_row").agg(best).select("_row", "best.cluster_id", "best.distance2")


def assign_nearest(df: DataFrame, vector: str, centers: DataFrame) -> DataFrame:
    """Add ``cluster_id`` and ``distance2``, the lowest id winning a tie.

    `centers` is (cluster_id, centroid), any number of them; those that hold null are
    left out. Both are null for a row without a vector of the centres' size. No row
    passes through the driver, and no more than BROADCAST_BYTES of centres.
    """
    points, count, width = _points(centers)
    carried = not any(isinstance(f.dataType, T.UserDefinedType) for f in df.schema.fields)  # as Arrow has them
    if carried and 8 * width * count <= BROADCAST_BYTES:
        ids, centres = _one_block(points)
        schema = T.StructType([*df.schema.fields, T.StructField("cluster_id", T.LongType()), T.StructField("distance2", T.DoubleType())])
        return df.mapInArrow(_rows_with_nearest(vector, max(1, BLOCK_BYTES // (8 * width)), ids, centres), schema)
    rows = write_out(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = write_out(_nearest_of_many(rows, vector, points, count, width), "nearest")
    return rows.join(found, "_row", "left").drop("_row")
