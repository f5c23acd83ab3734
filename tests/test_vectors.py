"""Vectors of an encoder in the clustering features."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from listora.operators import features, segments
from listora.settings import Settings

ROWS = [(i, ["a", "a", "bb", None][i % 4], ["x", "x", "", "x"][i % 4], float(i)) for i in range(40)]
SCHEMA = "row_id long, category string, description string, score double"
SETTINGS = Settings(numeric_features=("score",), text_weight=0.25, n_clusters=3)


@pytest.fixture
def lengths():
    """An encoder: loaded once a task, called with batches."""

    def encode(texts):
        for batch in texts:
            assert len(set(batch)) == len(batch)
            yield np.array([[len(text), text.count("x"), 1.0] for text in batch])

    return encode


def test_encoder_meets_each_text_once(spark, lengths):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    texts = df.select(features.combined_text(("category", "description")).alias("t"))
    made = features.encoded(texts, "t", lengths).collect()
    assert len(made) == 3 and len({r.digest for r in made}) == 3
    assert features.encoded(texts.where("false"), "t", lengths).count() == 0


def test_vectors_stand_before_the_numbers(spark, lengths):
    df = spark.createDataFrame(ROWS, SCHEMA)
    texts = {row[0]: f"{row[1] or ''} | {row[2]}" for row in ROWS}
    scores = np.array([row[3] for row in ROWS])
    wanted = {
        i: [0.25 * len(text), 0.25 * text.count("x"), 0.25, (i - scores.mean()) / scores.std()] for i, text in texts.items()
    }
    by_encoder = features.feature_matrix(df, SETTINGS, encode=lengths)
    given = features.encoded(df.select(features.combined_text(("category", "description")).alias("t")), "t", lengths)
    by_table = features.feature_matrix(df, SETTINGS, vectors=given)
    for matrix in (by_encoder, by_table):
        got = {r.row_id: r.features.toArray() for r in matrix.collect()}
        assert got.keys() == wanted.keys()
        assert all(np.allclose(got[i], wanted[i]) for i in wanted)


def test_a_text_without_vector_is_zero(spark, lengths):
    df = spark.createDataFrame(ROWS, SCHEMA)
    some = spark.createDataFrame([("a | x", [1.0, 2.0])], "t string, vector array<double>").select(features.digest(F.col("t")).alias("digest"), "vector")
    got = {r.row_id: r.features.toArray()[:2].tolist() for r in features.feature_matrix(df, SETTINGS, vectors=some).collect()}
    assert got[0] == [0.25, 0.5] and got[2] == [0.0, 0.0]
    with pytest.raises(ValueError):
        features.feature_matrix(df, SETTINGS, vectors=some.where("false"))
    with pytest.raises(ValueError):
        features.feature_matrix(df, SETTINGS, vectors=some, encode=lengths)


def test_segments_of_an_encoder(spark, lengths):
    df = spark.createDataFrame(ROWS, SCHEMA)
    clustered, model = segments.fit_segments(df, SETTINGS, encode=lengths)
    assert clustered.count() == len(ROWS) and len(model.clusterCenters()[0]) == 4


def test_distinct_texts_have_no_text_in_buffers(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("",)], "t string")
    found = features.distinct_texts(df, "t")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") == 2
    assert sorted(r.t for r in found.collect()) == ["", "a", "b"]
