"""The latest row of each id on a stream, batch by batch and across restarts."""

import random
from datetime import datetime, timedelta

import pytest

from listora.operators.identity import latest_per_id
from listora.session import scratch_path
from listora.streaming import ingest
from listora.streaming.latest import LatestTable, drain_latest

SCHEMA = "row_id long, place_id string, collected_at timestamp, name string"


def rows(rng, first, n):
    """Newer, older, undated and tied rows of few ids, and rows without one."""
    start = datetime(2026, 1, 1)
    return [
        (
            first + i,
            rng.choice(["P1", "P1", "P2", "P3", f"Q{rng.randrange(40)}", None, "", " "]),
            rng.choice([None, *(start + timedelta(days=rng.randrange(20)) for _ in range(6))]),
            rng.choice(["a", None, "b"]),
        )
        for i in range(n)
    ]


def told(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("per_batch", [1, 1000])
def test_restarts_from_its_state(spark, per_batch):
    rng = random.Random(per_batch)
    folder = scratch_path(spark, "in")
    table = LatestTable.in_scratch(spark, "place_id")
    batches = [spark.createDataFrame(rows(rng, 1000 * k, 60), SCHEMA) for k in range(5)]
    for batch in batches[:3]:
        batch.coalesce(1).write.mode("append").parquet(folder)
    stream = ingest.stream_parquet(spark, folder, batches[0].schema, files_per_batch=per_batch)
    whole = batches[0].union(batches[1]).union(batches[2])
    assert told(drain_latest(stream, "place_id", table)) == told(latest_per_id(whole, "place_id"))
    # nothing new: nothing changes
    assert told(drain_latest(stream, "place_id", table)) == told(latest_per_id(whole, "place_id"))
    for batch in batches[3:]:
        batch.coalesce(1).write.mode("append").parquet(folder)
    whole = whole.union(batches[3]).union(batches[4])
    again = ingest.stream_parquet(spark, folder, batches[0].schema, files_per_batch=per_batch)
    assert told(drain_latest(again, "place_id", table)) == told(latest_per_id(whole, "place_id"))


def test_older_rows_change_nothing(spark):
    folder = scratch_path(spark, "in")
    table = LatestTable.in_scratch(spark, "place_id")
    new = spark.createDataFrame([(5, "P", datetime(2026, 5, 1), "new"), (6, "R", None, "undated")], SCHEMA)
    old = spark.createDataFrame([(4, "P", datetime(2025, 5, 1), "old"), (7, "P", datetime(2026, 5, 1), "tied"), (2, "R", None, "lower row")], SCHEMA)
    for batch in (new, old):
        batch.coalesce(1).write.mode("append").parquet(folder)
        stream = ingest.stream_parquet(spark, folder, new.schema)
        found = {row.place_id: row.name for row in drain_latest(stream, "place_id", table).collect()}
    assert found == {"P": "new", "R": "lower row"}


def test_an_empty_stream(spark):
    folder = scratch_path(spark, "in")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    stream = ingest.stream_parquet(spark, folder, spark.createDataFrame([], SCHEMA).schema)
    assert drain_latest(stream, "place_id").count() == 0
