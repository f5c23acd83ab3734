"""One timestamp format from the data, and distinct counts from merged sketches."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from listora.operators import profile
from listora.operators.normalize import TIMESTAMP_FORMATS, coerce_types, inferred_format
from listora.settings import Settings


def times(spark, values):
    return spark.createDataFrame([(i, value) for i, value in enumerate(values)], "row_id long, collected_at string")


@pytest.mark.parametrize(
    ("values", "wanted"),
    [
        (["03/04/2026", "25/12/2026", "x", None], "dd/MM/yyyy"),
        (["03/04/2026", "12/25/2026", ""], "MM/dd/yyyy"),
        (["03/04/2026", "05/06/2026"], "dd/MM/yyyy"),  # as well read month first: the earlier format
        (["2026-03-01", "2026-03-02 10:00:00", "01.02.2026"], None),
        (["01.02.2026 10:30", "31.02.2026 10:30"], "dd.MM.yyyy HH:mm"),
        (["junk", None, ""], None),
        ([], None),
    ],
)
def test_format_that_reads_most(spark, values, wanted):
    assert inferred_format(times(spark, values), "collected_at") == wanted


def test_only_the_one_format_is_read(spark):
    settings = Settings(infer_timestamp_format=True)
    df = times(spark, ["12/25/2026 08:00:00", "12/26/2026 08:00:00", "25/12/2026 08:00:00", "2026-12-25", None])
    got = [r.collected_at for r in coerce_types(df, settings).orderBy("row_id").collect()]
    assert got == [datetime(2026, 12, 25, 8), datetime(2026, 12, 26, 8), None, None, None]
    assert TIMESTAMP_FORMATS[0].startswith("dd.MM")


def told(df):
    return {r.metric: (r.n_rows, r.n_distinct) for r in profile.distinct_estimates(df).collect()}


def test_merged_halves_equal_the_whole(spark):
    columns = {"ids": "id", "tens": "ten", "absent": "absent"}
    df = spark.range(40_000).select("id", (F.col("id") % 10).alias("ten"))
    whole = profile.distinct_sketches(df, columns)
    halves = profile.distinct_sketches(df.filter("id < 9000"), columns).union(profile.distinct_sketches(df.filter("id >= 9000"), columns))
    again = halves.union(profile.distinct_sketches(df.limit(0), columns))
    assert told(profile.merged_sketches(again)) == told(profile.merged_sketches(whole))
    blank = spark.createDataFrame([("",), (" ",), ("a",), (None,), ("",)], "ids string")
    assert told(profile.distinct_sketches(blank, {"ids": "ids"})) == {"ids": (5, 3)}
    found = told(whole)
    assert found["tens"] == (40_000, 10) and found["absent"] == (40_000, 0)
    assert abs(found["ids"][1] - 40_000) <= 0.03 * 40_000
