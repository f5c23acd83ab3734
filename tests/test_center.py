"""Exact medians: what crosses the shuffle, and values against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from listora.operators import profile


def medians(df, fields):
    return {r.field: (r.mean, r.median) for r in profile.profile_center(df, fields).collect()}


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 30_001])
def test_against_numpy(spark, n):
    rng = np.random.default_rng(n)
    columns = {"a": rng.normal(size=n), "b": rng.integers(0, 3, n).astype(float), "c": np.full(n, 7.5)}
    rows = [tuple(float(columns[c][i]) for c in columns) for i in range(n)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(6)
    got = medians(df, ("a", "b", "c"))
    for name, values in columns.items():
        assert np.allclose(got[name], (values.mean(), np.median(values)))


def test_no_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    assert medians(df, ("a", "b")) == {"b": (2.0, 2.0)}
    assert medians(df.where("false"), ("a", "b")) == {}


def test_only_the_bracket_is_shuffled(spark):
    lines = spark.range(100_000).select(F.lit("a").alias("field"), F.col("id").cast("double").alias("value"))
    found = profile._bracketed(lines, {"a": (49_990.0, 50_010.0)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "Filter" in plan[exchange:] and "Filter" not in plan[:exchange]
    rows = found.collect()
    assert len(rows) == 22 and {r.copies for r in rows if r.value is None} == {49_990}
    ranked = profile._with_ranks(found)
    assert {r.value: r.up_to for r in ranked.collect() if r.value}[50_000.0] == 50_001
    assert "Window" in ranked._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in ranked._jdf.queryExecution().executedPlan().toString().split("\n") if "+- Window" in line or "Window [" in line]
    assert all("run" in line for line in windows)
