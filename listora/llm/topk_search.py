"""Exact top-k search by no-random-access aggregation over sorted lists.

Vectors are dealt into blocks. In a block each component has a list of its vectors by value, which queries with a
positive weight read from the top and queries with a negative weight from the bottom. All lists are read to the same
depth. What a query has not read of a vector lies between the list's end and the value at that depth, which bounds the
vector's score from below and above. A vector whose upper bound is under the k-th highest lower bound cannot qualify; a
query stops reading when no more vectors are left than are worth resolving, and these get their final scores.

Queries and vectors meet block by block: a block of queries against a block of vectors is one task, and its k best go to
a last ranking for each query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VECTORS = 2048  # of a block
QUERIES = 512  # of a block
DEPTHS = (1 / 8, 1 / 4, 1 / 2)  # of a list; after the last, what is left is resolved
WORTH_RESOLVING = 4  # times k vectors for a query


class SortedLists:
    """Components of the vectors of a block, each with its own order; bounds of all scores at a depth."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(np.float64)  # whole numbers: products and sums below 2**53 are exact
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.low, self.high = self.vectors.min(axis=0), self.vectors.max(axis=0)

    def read(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Least and greatest possible component of every vector, after reading from the top and from the bottom."""
        columns = np.arange(self.vectors.shape[1])
        top, bottom = self.order[-depth:], self.order[:depth]
        at_top, at_bottom = self.vectors[top[0], columns], self.vectors[bottom[-1], columns]
        top_low, top_high = np.broadcast_to(self.low, self.vectors.shape).copy(), np.broadcast_to(at_top, self.vectors.shape).copy()
        bottom_low, bottom_high = np.broadcast_to(at_bottom, self.vectors.shape).copy(), np.broadcast_to(self.high, self.vectors.shape).copy()
        for known, seen in ((top_low, top), (top_high, top), (bottom_low, bottom), (bottom_high, bottom)):
            known[seen, columns] = self.vectors[seen, columns]
        return top_low, top_high, bottom_low, bottom_high


def best(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places of its k best vectors among those of another id, and their scores."""
    lists = SortedLists(vectors)
    positive, negative = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    barred = own[:, None] == ids[None, :]
    left = ~barred
    going = np.arange(len(queries))
    for share in DEPTHS:
        depth = math.ceil(share * len(vectors))
        if not len(going) or depth >= len(vectors) or len(vectors) <= WORTH_RESOLVING * k:
            break
        top_low, top_high, bottom_low, bottom_high = lists.read(depth)
        lower = positive[going] @ top_low.T + negative[going] @ bottom_high.T
        upper = positive[going] @ top_high.T + negative[going] @ bottom_low.T
        lower[barred[going]] = -np.inf
        bound = np.partition(lower, len(vectors) - k, axis=1)[:, len(vectors) - k]
        left[going] &= upper >= bound[:, None]
        going = going[left[going].sum(axis=1) > WORTH_RESOLVING * k]
    out = []
    for i, query in enumerate(queries.astype(np.float64)):
        places = np.flatnonzero(left[i])
        scores = lists.vectors[places] @ query
        order = np.lexsort((ids[places], -scores))[:k]
        out.append((places[order], scores[order]))
    return out


def _block(k: int):
    def run(key: tuple, queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_id": [], "query_at": [], "vec_id": [], "score": []}
        if len(queries) and len(vectors):
            ids, matrix = vectors["vec_id"].to_numpy(), np.stack(vectors["parts"].to_list())
            own, weights = queries["vec_id"].to_numpy(), np.stack(queries["parts"].to_list())
            for i, (places, scores) in enumerate(best(weights, own, ids, matrix, k)):
                columns["query_id"].extend([own[i]] * len(places))
                columns["query_at"].extend([queries["at"].iloc[i]] * len(places))
                columns["vec_id"].extend(ids[places])
                columns["score"].extend(np.rint(scores).astype(np.int64))
        return pd.DataFrame(columns).astype("int64")

    return run


def whole_parts(embedding: Column) -> Column:
    """floor(1024 * x) of every component, or null if the vector or a component is null or not finite."""
    finite = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    parts = F.transform(embedding, lambda x: F.floor(x.cast("double") * 1024))
    return F.when(F.coalesce(finite, F.lit(False)), parts)


def top_scores(vectors: DataFrame, is_query: Column, k: int = 10, block: int = VECTORS, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of every query with vectors of other ids.

    `is_query` picks the queries among rows vec_id, embedding. Equal scores go to the smaller vec_id. Vectors that are
    null or empty or hold a null, NaN or infinite component take no part, nor do rows with a null vec_id. Repeated rows
    count once; different vectors that share a vec_id are candidates each, and queries each, ranked apart. Queries with
    fewer candidates have fewer rows. Vectors of different lengths are never compared: a query meets those of its own
    length. Other columns are left out. An empty table gives no rows. Scores have to stay below 2**53.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), whole_parts(F.col("embedding")).alias("parts"), is_query.alias("is_query")
    ).where("vec_id IS NOT NULL AND parts IS NOT NULL AND size(parts) > 0")
    # one row for each distinct (vec_id, vector), told by a hash of both
    rows = rows.groupBy(F.xxhash64("vec_id", "parts").alias("at"), "vec_id", "parts").agg(F.max("is_query").alias("is_query"))
    counts = rows.groupBy(F.size("parts").alias("length")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("n_queries")
    )
    counts = counts.agg(F.max("n").alias("n"), F.max("n_queries").alias("n_queries")).first()
    n_blocks = math.ceil((counts.n or 0) / block) or 1
    n_query_blocks = math.ceil((counts.n_queries or 0) / queries) or 1
    of_block = F.pmod("at", F.lit(n_blocks))
    of_query_block = F.pmod(F.xxhash64("at"), F.lit(n_query_blocks))
    length = F.size("parts").alias("length")
    to_queries = F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))).alias("query_block")
    to_vectors = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("vector_block")
    candidates = rows.select(length, of_block.cast("int").alias("vector_block"), to_queries, "at", "vec_id", "parts")
    asking = rows.where("is_query").select(
        length, to_vectors, of_query_block.cast("int").alias("query_block"), "at", "vec_id", "parts"
    )
    by = ("length", "vector_block", "query_block")
    found = asking.groupBy(*by).cogroup(candidates.groupBy(*by)).applyInPandas(
        _block(k), "query_id long, query_at long, vec_id long, score long"
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "query_at").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
