import random

import pytest
from pyspark.sql import functions as F

from listora.functions.similarity import lcs_of_pairs, ratio
from listora.operators.fuzzy import (
    dedup_fuzzy,
    first_wins,
    fuzzy_matches,
    match_key,
    resolve_entities,
    similar_pairs,
)
from listora.operators.identity import dedup_exact, latest_per_id, scans_repeat
from listora.plans import runs

IDS = "row_id long, place_id string, cid string, collected_at timestamp, name string"
FUZZY = "row_id long, place_id string, cid string, name string, street_address string, zip_code string"


def day(text):
    from datetime import datetime

    return datetime.fromisoformat(text)


def lcs(a, b):
    above = [0] * (len(b) + 1)
    for x in a:
        here = [0]
        for j, y in enumerate(b):
            here.append(max(here[-1], above[j + 1], above[j] + (x == y)))
        above = here
    return above[-1]


def alike(a, b, threshold):
    return a == b or 200 * lcs(a, b) >= threshold * (len(a) + len(b))


def walk(keys, threshold):
    """The rule, row by row: positions of the rows that stay."""
    stay = []
    for i, key in enumerate(keys):
        if not any(alike(keys[j], key, threshold) for j in stay):
            stay.append(i)
    return stay


def test_keeps_the_most_recent(spark):
    df = spark.createDataFrame(
        [
            (1, "P1", "C1", day("2026-01-01"), "Old Record"),
            (2, "P1", "C1", day("2026-03-01"), "New Record"),
            (3, "P2", "C2", day("2026-02-01"), "Other"),
        ],
        IDS,
    )
    assert {r.place_id: r.name for r in dedup_exact(df).collect()} == {
        "P1": "New Record", "P2": "Other",
    }


def test_rows_without_id_all_stay(spark):
    df = spark.createDataFrame(
        [(i, [None, "", " "][i % 3], None, None, "n") for i in range(30)], IDS
    )
    assert latest_per_id(df, "place_id").count() == 30


def test_place_id_wins_over_a_newer_row_without(spark):
    df = spark.createDataFrame(
        [
            (1, "P1", "C1", day("2026-01-01"), "placed"),
            (2, None, "C1", day("2026-05-01"), "newer"),
        ],
        IDS,
    )
    assert [r.name for r in dedup_exact(df).collect()] == ["placed"]


def test_undated_rows_come_last_and_ties_go_to_the_lower_row(spark):
    df = spark.createDataFrame(
        [
            (1, "P1", None, None, "undated"), (2, "P1", None, day("2020-01-01"), "dated"),
            (4, "P2", None, day("2026-01-01"), "later row"), (3, "P2", None, day("2026-01-01"), "first row"),
        ],
        IDS,
    )
    assert sorted(r.name for r in dedup_exact(df).collect()) == ["dated", "first row"]


def test_hot_id_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr(
        "id AS row_id", "CAST(id % 3 AS STRING) AS place_id", "timestamp_seconds(id) AS collected_at"
    )
    plan = latest_per_id(df, "place_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_cleaning_is_worked_out_for_the_rows_that_stay(spark):
    """The join with the rows that stay comes first; rows numbered in the plan are not scanned twice."""
    rows = spark.range(0, 1000, 1, 4).selectExpr(
        "id AS row_id", "CAST(id % 3 AS STRING) AS place_id", "CAST(NULL AS STRING) AS cid", "timestamp_seconds(id) AS collected_at",
        "IF(id = 999, 'x', 'name') AS name", "'030/1234567' AS phone",
    )
    found = runs.cleaned_survivors(rows)
    assert sorted((r.row_id, r.phone_normalized) for r in found.collect()) == [(n, "+49301234567") for n in (996, 997, 998)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "phone_normalized" in plan[: plan.index("LeftSemi")] and "Window" not in plan
    numbered = rows.drop("row_id").withColumn("row_id", F.monotonically_increasing_id())
    assert not scans_repeat(numbered) and runs.cleaned_survivors(numbered).count() == 3


def test_near_names_collapse_in_a_block(spark):
    rows = [
        (1, None, None, "Hope Rehab Center", "1 Main St", "20095"),
        (2, None, None, "Hope Rehab Centre", "1 Main St", "20095"),
        (3, None, None, "Totally Different Name", "9 Other Ave", "20095"),
        (4, None, None, "Hope Rehab Center", "1 Main St", "10115"),
        (5, None, None, "Hope Rehab Center", "1 Main St", None),
        (6, "P", None, "Hope Rehab Center", "1 Main St", "20095"),
    ]
    got = dedup_fuzzy(spark.createDataFrame(rows, FUZZY), threshold=85)
    assert sorted(r.row_id for r in got.collect()) == [1, 3, 4, 5, 6]


def test_without_block_column_nothing_is_compared(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "a")], "row_id long, cid string, name string")
    assert dedup_fuzzy(df).count() == 2


def test_address_stands_in_only_for_an_absent_street(spark):
    df = spark.createDataFrame([("b a", "x", None)], "name string, address string, street_address string")
    assert df.select(match_key(df.columns).alias("k")).first().k == "a b"
    df = df.drop("street_address")
    assert df.select(match_key(df.columns).alias("k")).first().k == "a b x"


def test_lcs_against_the_plain_table():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé 𝄞") for _ in range(rng.randint(0, 90))) for _ in range(300)]
    left, right = words[:150], words[150:]
    assert lcs_of_pairs(left, right).tolist() == [lcs(a, b) for a, b in zip(left, right)]


def test_ratio(spark):
    pairs = [("abc", "abc"), ("abc", "abd"), ("", ""), ("a", ""), ("ab" * 50, "ba" * 50), (None, "a")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.x for r in df.select(ratio(F.col("a"), F.col("b")).alias("x")).collect()]
    wanted = [100.0, 200 * 2 / 6, 100.0, 0.0, 200 * lcs("ab" * 50, "ba" * 50) / 200, None]
    assert got == pytest.approx(wanted)


def mutated(rng, text):
    chars = list(text)
    for _ in range(rng.randint(0, 5)):
        i = rng.randint(0, len(chars))
        if rng.random() < 0.5:
            chars.insert(i, rng.choice("abcdé "))
        elif i < len(chars):
            del chars[i]
    return "".join(chars)


def sample_texts(rng, n):
    bases = [
        "".join(rng.choice("abcdé ") for _ in range(rng.choice([0, 1, 3, 6, 12, 20, 30, 45, 70])))
        for _ in range(12)
    ]
    return [mutated(rng, rng.choice(bases)) for _ in range(n)]


@pytest.mark.parametrize("threshold", [60, 75, 92, 99.5])
def test_pairs_against_brute_force(spark, threshold):
    rng = random.Random(int(threshold))
    keys = sorted(set(sample_texts(rng, 150)))
    rng.shuffle(keys)
    rows = [("z", i, k) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "block string, ord long, key string")
    got = {(r.src, r.dst) for r in similar_pairs(df, df, threshold).collect()}
    wanted = {
        (i, j)
        for i in range(len(keys)) for j in range(i + 1, len(keys))
        if alike(keys[i], keys[j], threshold)
    }
    assert got == wanted


@pytest.mark.parametrize("threshold", [80, 92])
def test_small_batches_against_the_row_by_row_rule(spark, threshold):
    """Several batches a block, so every step of the settling is exercised."""
    rng = random.Random(threshold)
    rows, wanted = [], []
    for block in ("z1", "", "z2"):
        texts = sample_texts(rng, 120)
        start = len(rows)
        rows += [(start + i, None, None, t, None, block) for i, t in enumerate(texts)]
        wanted += [start + i for i in walk([" ".join(sorted(t.split())) for t in texts], threshold)]
    df = spark.createDataFrame(rows, FUZZY)
    got = dedup_fuzzy(df, threshold=threshold, first_batch=6, growth=4)
    assert sorted(r.row_id for r in got.collect()) == wanted


def test_a_block_of_copies(spark):
    """A third of all rows alike: few comparisons, the first row stays."""
    rows = [(i, None, None, f"Hope Rehab Center {i % 7}", "1 Main St", "z") for i in range(3000)]
    got = dedup_fuzzy(spark.createDataFrame(rows, FUZZY))
    assert [r.row_id for r in got.collect()] == [0]


def test_removed_rows_remove_nobody(spark):
    # 1 - 2 - 3 in a chain: 2 goes because of 1, so 3 stays
    edges = spark.createDataFrame(
        [("z", 1, 2), ("z", 2, 3), ("y", 1, 2)], "block string, src long, dst long"
    )
    assert sorted((r.block, r.ord) for r in first_wins(edges).collect()) == [("y", 2), ("z", 2)]


def test_matches_name_the_first_kept_row(spark):
    rows = [
        (1, None, None, "Hope Rehab Center", "1 Main St", "z"),
        (2, None, None, "Hope Rehab Centre", "1 Main St", "z"),
        (3, None, None, "Totally Different Name", "9 Other Ave", "z"),
    ]
    found = fuzzy_matches(spark.createDataFrame(rows, FUZZY), threshold=85).collect()
    assert [(r.removed_row, r.kept_row) for r in found] == [(2, 1)]
    assert found[0].score == pytest.approx(200 * 26 / 54)


def test_resolving_twice_changes_nothing(spark, sf_dir):
    from listora.plans.fixture import cleaned_listings
    from listora.session import write_out

    once = write_out(resolve_entities(cleaned_listings(spark, sf_dir)), "once")
    assert resolve_entities(once).count() == once.count()
