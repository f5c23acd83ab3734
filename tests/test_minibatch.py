"""Mini-batch k-means: the step against plain sums, the fit against a full one, batches of a stream."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from listora.operators.minibatch import fit_mini_batch, updated_centres
from listora.operators.segments import assign_nearest

CENTRES = "cluster_id long, centroid array<double>, weight long"


def told(centres):
    return {r.cluster_id: (r.centroid, r.weight) for r in centres.collect()}


def test_a_step_is_the_mean_of_all_taken_so_far(spark):
    centres = spark.createDataFrame([(0, [0.0, 0.0], 3), (1, [10.0, 10.0], 0), (2, [-50.0, 0.0], 7)], CENTRES)
    rows = spark.createDataFrame([([1.0, 1.0],), ([3.0, -1.0],), ([12.0, 10.0],), (None,)], "v array<double>")
    got = told(updated_centres(centres, rows, "v"))
    assert got[0] == (pytest.approx([4 / 5, 0.0]), 5)
    assert got[1] == ([12.0, 10.0], 1)
    assert got[2] == ([-50.0, 0.0], 7)
    assert told(updated_centres(centres, rows.where("false"), "v"))[0] == ([0.0, 0.0], 3)


def test_fit_comes_near_a_full_one(spark):
    rng = np.random.default_rng(11)
    middles = rng.normal(size=(6, 8)) * 6
    points = [(i, (middles[i % 6] + rng.normal(size=8)).tolist()) for i in range(3000)]
    rows = spark.createDataFrame(points, "id long, v array<double>").repartition(7)
    centres = fit_mini_batch(rows, "id", "v", k=6, seed=3)
    again = fit_mini_batch(rows.repartition(3), "id", "v", k=6, seed=3)
    assert sum(weight for _, weight in told(centres).values()) == 3000
    for i, (centroid, weight) in told(centres).items():
        assert told(again)[i] == (pytest.approx(centroid), weight)
    full = KMeans(k=6, seed=3).fit(rows.select(array_to_vector("v").alias("features")))
    cost = assign_nearest(rows, "v", centres.drop("weight")).agg(F.sum("distance2")).first()[0]
    assert cost <= 1.05 * full.summary.trainingCost
