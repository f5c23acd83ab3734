"""Nearest centres in blocks against all distances."""

import numpy as np
import pytest

from listora.operators import nearest
from listora.operators.nearest import assign_nearest


def tables(spark, points, centres, first_id=0):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "id long, v array<double>").repartition(4)
    return rows, spark.createDataFrame([(first_id + i, c) for i, c in enumerate(centres)], "cluster_id long, centroid array<double>").repartition(4)


def plain(points, centres):
    distance = ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    return distance.argmin(axis=1), distance.min(axis=1)


@pytest.mark.parametrize("block, broadcast", [(4 << 20, 16 << 20), (2048, 16 << 20), (2048, 0)])
def test_blocks_against_all_distances(spark, monkeypatch, block, broadcast):
    monkeypatch.setattr(nearest, "BLOCK_BYTES", block)
    monkeypatch.setattr(nearest, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(nearest, "SLICE", 16)
    rng = np.random.default_rng(block + broadcast)
    points = np.concatenate([rng.normal(size=(300, 6)), rng.normal(size=(50, 6)) * 100, np.zeros((3, 6))])
    centres = np.concatenate([rng.normal(size=(150, 6)), points[::7], points[::7], np.zeros((2, 6))])
    rows, table = tables(spark, points.tolist(), centres.tolist())
    which, distance = plain(points, centres)
    got = {r.id: (r.cluster_id, r.distance2) for r in assign_nearest(rows, "v", table).collect()}
    assert [got[i][0] for i in range(len(points))] == which.tolist()
    assert np.allclose([got[i][1] for i in range(len(points))], distance, rtol=1e-12, atol=0)


def test_twenty_thousand_centres(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20_000, 64))
    points = centres[rng.integers(0, 20_000, 400)] + rng.normal(size=(400, 64)) * 0.01
    rows, table = tables(spark, points.tolist(), centres.tolist(), first_id=7)
    got = {r.id: r.cluster_id - 7 for r in assign_nearest(rows, "v", table).select("id", "cluster_id").collect()}
    exact = ((points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)
    assert [got[i] for i in range(400)] == exact.tolist()


def test_far_slices_are_skipped(monkeypatch):
    """Centres of other norms are not looked at once a near one is known."""
    monkeypatch.setattr(nearest, "SLICE", 8)
    rng = np.random.default_rng(6)
    centres = np.concatenate([rng.normal(size=(64, 4)) * scale for scale in (1, 50, 2500)])
    centres = centres[np.argsort(np.linalg.norm(centres, axis=1))]
    points = centres[rng.integers(60, 64, 20)] + 1e-3
    looked = []
    monkeypatch.setattr(nearest.np, "nonzero", lambda near, real=np.nonzero: (looked.append(near.shape), real(near))[1])
    found, best = nearest._best_of(points, np.arange(len(centres)), centres)
    assert found.tolist() == plain(points, centres)[0].tolist()
    assert sum(shape[0] * shape[1] for shape in looked if len(shape) == 2) < 0.4 * len(points) * len(centres)


def test_odd_rows(spark):
    rows, table = tables(spark, [[1.0, 2.0], None, [1.0], [float("nan"), 0.0], [None, 1.0]], [[0.0, 0.0], None, [1.0, None]])
    got = {r.id: (r.cluster_id, r.distance2) for r in assign_nearest(rows, "v", table).collect()}
    assert got[0] == (0, 5.0) and got[1] == got[2] == got[4] == (None, None)
    assert assign_nearest(rows.where("false"), "v", table).count() == 0
    assert {r.cluster_id for r in assign_nearest(rows, "v", table.where("false")).collect()} == {None}


def test_rows_keep_their_columns_and_are_not_shuffled(spark):
    """Vectors stay where they are: with few centres no row is dealt, sorted or joined back."""
    rows = spark.sql(
        """SELECT id, timestamp '2026-03-01 04:05:06' AS at, named_struct('a', array(id, NULL)) AS nested,
        CASE WHEN id % 3 > 0 THEN array(CAST(id AS FLOAT), 1.0F) END AS v, CAST(NULL AS STRING) AS nothing FROM range(0, 50, 1, 4)"""
    )
    table = spark.createDataFrame([(5, [0.0, 1.0]), (9, [40.0, 1.0])], "cluster_id long, centroid array<double>")
    found = assign_nearest(rows, "v", table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert found.drop("cluster_id", "distance2").exceptAll(rows).count() == 0
    want = {i: ((5, float(i * i)) if i <= 20 else (9, float((40 - i) ** 2))) if i % 3 else (None, None) for i in range(50)}
    assert {r.id: (r.cluster_id, r.distance2) for r in found.collect()} == want


def test_a_task_has_one_python_worker(spark, monkeypatch):
    """No worker feeds another: two in a row hung over 36 million rows. Odd vectors may lie in any block."""
    monkeypatch.setattr(nearest, "BLOCK_BYTES", 64)
    rows = spark.createDataFrame(
        [(i, [None, 1.0] if i % 5 == 0 else None if i % 5 == 1 else [1.0] if i % 5 == 2 else [float(i), 1.0]) for i in range(60)],
        "id long, v array<double>",
    ).coalesce(1)
    table = spark.createDataFrame([(5, [0.0, 1.0]), (9, [40.0, 1.0])], "cluster_id long, centroid array<double>")
    found = assign_nearest(rows, "v", table)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = {i: ((5, float(i * i)) if i <= 20 else (9, float((40 - i) ** 2))) if i % 5 > 2 else (None, None) for i in range(60)}
    assert {r.id: (r.cluster_id, r.distance2) for r in found.collect()} == want


@pytest.mark.parametrize("name", ["kmeans_fit", "fit_metrics"])
def test_no_vector_is_joined_to_its_row(spark, sf_dir, name):
    from listora.plans.catalog import QUERIES

    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_id" in plan
    assert not any("Join" in line and "row_id" in line for line in plan.splitlines())
