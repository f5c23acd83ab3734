"""Likeness in the JVM, candidates of a crowded block, and settlement by component."""

import random

import pytest
from pyspark.sql import functions as F

from listora.functions.similarity import indels, lcs_length, lcs_of_pairs, ratio
from listora.operators import fuzzy


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, name, work):
    """Jobs that a piece of work starts."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def texts(rng, n, longest):
    out = []
    for _ in range(n):
        a = [rng.choice("abcdefghij é𝄞01") for _ in range(rng.randint(0, longest))]
        b = list(a) if rng.random() < 0.6 else [rng.choice("abcdefghij é") for _ in range(rng.randint(0, longest))]
        for _ in range(rng.randint(0, 8)):
            if b and rng.random() < 0.5:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randint(0, len(b)), rng.choice("abcxyz"))
        out.append(("".join(a), "".join(b)))
    return out


@pytest.mark.parametrize("n, longest", [(10_000, 62), (300, 260)])
def test_column_against_the_plain_table(spark, n, longest):
    pairs = texts(random.Random(longest), n, longest)
    df = spark.createDataFrame(pairs, "a string, b string").repartition(8)
    found = df.select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n"), indels(F.col("a"), F.col("b")).alias("d"))
    assert "Python" not in plan_of(found.select("n", "d"))
    rows = found.collect()
    wanted = lcs_of_pairs([r.a for r in rows], [r.b for r in rows]).tolist()
    assert [r.n for r in rows] == wanted
    assert [r.d for r in rows] == [len(r.a) + len(r.b) - 2 * n for r, n in zip(rows, wanted)]


def test_word_borders(spark):
    pairs = [("x" * n, "x" * m) for n in (61, 62, 63, 123, 124, 125) for m in (61, 62, 124, 200)]
    pairs += [("ab" * 62, "ba" * 62), ("é" * 124, "é" * 62 + "z" + "é" * 62), ("", "x" * 99), ("", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r.n for r in df.select(lcs_length(F.col("a"), F.col("b")).alias("n")).collect()]
    assert got == lcs_of_pairs([a for a, _ in pairs], [b for _, b in pairs]).tolist()
    assert spark.createDataFrame([(None, "a")], "a string, b string").select(lcs_length(F.col("a"), F.col("b"))).first()[0] is None


def test_likeness_plans_without_python(spark):
    df = spark.createDataFrame([("z", 1, "abc"), ("z", 2, "abd")], "block string, ord long, key string")
    assert "Python" not in plan_of(fuzzy.similar_pairs(df, df, 80))
    assert "Python" not in plan_of(df.select(ratio(F.col("key"), F.col("block"))))


def crowded(rng, n):
    """Names of one block that share a street, and a few near copies."""
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(24)) for _ in range(n)]
    for i in range(0, n, 100):
        names[i] = names[i + 1][:-1] + "#"
    return [("z", i, f"12 Grossenhainer {name} Strasse") for i, name in enumerate(names)]


def test_a_common_street_brings_nobody_together(spark):
    """Candidates grow about as the keys do: what a block shares is none of the rarest pieces."""
    found = {}
    for n in (5_000, 20_000):
        rows = crowded(random.Random(n), n)
        df = spark.createDataFrame(rows, "block string, ord long, key string").repartition(8)
        met = fuzzy.candidates(df, df, 92)
        found[n] = met.count()
        planted = {(i, i + 1) for i in range(0, n, 100)}
        assert planted <= {(r.a_ord, r.b_ord) for r in met.filter("a_ord % 100 = 0 AND b_ord = a_ord + 1").collect()}
    assert found[20_000] <= 20_000
    assert found[20_000] <= 8 * max(found[5_000], 200)


def walk(edges):
    lost = set()
    for block, src, dst in sorted(edges):
        if (block, src) not in lost:
            lost.add((block, dst))
    return sorted(lost)


def told(df):
    return sorted((r.block, r.ord) for r in df.collect())


EDGES = "block string, src long, dst long"


def test_a_long_chain_takes_no_rounds(spark):
    def lost(n):
        chain = [("z", i, i + 1) for i in range(n)]
        seen = fuzzy.Settling()
        df = spark.createDataFrame(chain, EDGES)
        out, jobs = jobs_of(spark, f"chain-{n}", lambda: told(fuzzy.first_wins(df, told=seen)))
        assert out == walk(chain)
        return jobs, seen

    (short, _), (long, seen) = lost(10), lost(1000)
    assert long == short
    assert seen == fuzzy.Settling()


@pytest.mark.parametrize("replayed", [100_000, 25, 3])
def test_settlement_against_the_walk(spark, replayed):
    """Whole blocks, components, and components too large to be replayed, by the same rule."""
    rng = random.Random(replayed)
    edges = set()
    for block in ("", "y", "z"):
        for _ in range(120):
            a = rng.randrange(200)
            edges.add((block, a, a + rng.randint(1, 6)))
    edges |= {("chain", i, i + 1) for i in range(60)} | {("pair", 5, 9)}
    df = spark.createDataFrame(sorted(edges) * 2, EDGES)
    seen = fuzzy.Settling()
    assert told(fuzzy.first_wins(df, replayed, seen)) == walk(edges)
    assert (seen.rounds > 0) == (replayed < 60)
    assert (seen.label_steps > 0) == (replayed < 100_000)
    assert seen.label_steps <= 12


def test_no_edges(spark):
    assert told(fuzzy.first_wins(spark.createDataFrame([], EDGES))) == []
