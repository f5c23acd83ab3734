"""Top-k search against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from listora.llm import topk_search


def brute(rows, k):
    vectors = {
        (vec_id, tuple(math.floor(1024 * float(np.float32(x))) for x in vector))
        for vec_id, vector in rows
        if vec_id is not None and vector and all(x is not None and math.isfinite(x) for x in vector)
    }
    out = []
    for query_id, asked in vectors:
        if query_id % 100 == 0:
            scores = sorted(
                (-sum(a * b for a, b in zip(asked, vector, strict=True)), vec_id)
                for vec_id, vector in vectors
                if vec_id != query_id and len(vector) == len(asked)
            )
            out += [(query_id, rank, vec_id, -score) for rank, (score, vec_id) in enumerate(scores[:k], 1)]
    return sorted(out)


def made_rows(n, size, seed):
    rng = random.Random(seed)
    hot = [rng.gauss(0, 0.1) for _ in range(size)]
    rows = [(i, hot if rng.random() < 0.3 else [rng.gauss(0, 0.1) for _ in range(size)]) for i in range(n)]
    rows += [rows[0], rows[0], (100, rows[5][1]), (n, None), (n + 1, []), (None, hot), (200, [float("nan")] * size)]
    rows += [(n + 2, [None] + hot[1:]), (n + 3, [float("inf")] + hot[1:]), (300, hot[:3]), (n + 4, hot[1:4])]
    return rows


@pytest.mark.parametrize(("block", "queries"), [(2048, 512), (40, 2)])
@pytest.mark.parametrize("k", [1, 10])
def test_equals_brute_force(rows_of, block, queries, k):
    rows = made_rows(450, 16, 3)
    table = rows_of([{"vec_id": a, "embedding": b, "rank": 1} for a, b in rows], "vec_id long, embedding array<float>, rank int")
    found = topk_search.top_scores(table, F.col("vec_id") % 100 == 0, k, block, queries).collect()
    assert sorted(map(tuple, found)) == brute(rows, k)


def test_stops_early_on_aligned_lists():
    rng = np.random.default_rng(2)
    strong = np.arange(1000)[::-1, None]
    vectors = strong * np.array([9, 5, 1]) + rng.integers(0, 3, (1000, 3))
    lists = topk_search.SortedLists(vectors)
    top_low, top_high, bottom_low, bottom_high = lists.read(125)
    assert (top_low <= vectors).all() and (vectors <= top_high).all()
    assert (bottom_low <= vectors).all() and (vectors <= bottom_high).all()
    lower, upper = top_low.sum(axis=1), top_high.sum(axis=1)
    assert (upper >= np.sort(lower)[-10]).sum() < 200  # outsiders are ruled out after an eighth of the lists
    places, scores = topk_search.best(np.array([[1, 1, 1]]), np.array([-1]), np.arange(1000), vectors, 10)[0]
    assert scores.tolist() == sorted(vectors.sum(axis=1).tolist(), reverse=True)[:10] and len(places) == 10


def test_empty_table(rows_of):
    none = rows_of([], "vec_id long, embedding array<float>")
    assert topk_search.top_scores(none, F.col("vec_id") % 100 == 0).count() == 0
