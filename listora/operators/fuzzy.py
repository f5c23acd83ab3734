"""Entity resolution by likeness, for rows that carry no id at all.

Rule: walk the rows of a block in processing order; a row that is still there
removes every later row of its block scoring at or above the threshold. Removed
rows remove nobody.

How it runs on Spark, without ever meeting all pairs of a block:

1.  Equal match keys collapse to their first row (a partial aggregate, so any
    number of copies costs one row per task).
2.  Candidates come from an equi-join of short pieces. k insertions and
    deletions touch at most k of the pieces a text is cut into, so one of any
    k+1 of them stands in the other text, near its place (the asymmetric chunks
    and grams of Qin, Wang, Lu, Xiao, Lin, SIGMOD 2011). The k+1 pieces that are
    rarest in their block are taken: what a whole block shares, such as a street,
    brings nobody together as long as a text has k+1 pieces besides.
3.  Survivors are settled in batches of growing size per block. A row is first
    held against the rows kept in earlier batches, and only what remains is
    compared inside its own batch. In a dense group of near copies nearly all
    rows are thus removed against few kept ones, instead of pairing up among
    themselves (the prefix argument of Blelloch, Fineman, Shun, SPAA 2012).
4.  Within a batch the rule is settled on the edge table. Edges that hang
    together are replayed in order by one task: a block's edges where they are
    few, else the connected components of its edges. Only components with more
    edges than one task replays take rounds, in which a row that no undecided
    earlier row is alike to stays, and its later neighbours go.

Batches and rounds are written to the shared folder, so a lost executor costs
one step and every decision is taken once.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listora.functions.similarity import SCALE, allowed_edits, lcs_length, ratio, scaled
from listora.functions.text import sorted_tokens
from listora.operators.identity import dedup_exact, has_any_id, processing_order
from listora.schema import ROW_ID
from listora.session import row_count, write_out, write_out_with
from listora.settings import Settings

FIRST_BATCH = 256  # rows per block in the first batch
BATCH_GROWTH = 4
REPLAYED = 100_000  # edges that hang together and that one task replays
PIECE = 3  # characters of a piece, where a text has enough of them


def match_text(columns) -> Column:
    """Name and street; the full address stands in only where no street column
    exists. A missing part counts as empty."""
    street = next((c for c in ("street_address", "address") if c in columns), None)
    parts = [F.col(c) if c in columns else F.lit("") for c in ("name", street or "")]
    return F.concat_ws(" ", *(F.coalesce(p, F.lit("")) for p in parts))


def match_key(columns) -> Column:
    return sorted_tokens(match_text(columns))


# ---------------------------------------------------------------- candidates

# Character counts of a text, cut off at three: bit c of mask n says that
# characters of class c occur at least n times. An insertion or deletion moves
# one count by one and so flips at most one bit, which makes differing bits a
# lower bound for the edits that costs three machine words to look up.
_COUNTED = """
aggregate(split(key, ''), named_struct('m1', 0L, 'm2', 0L, 'm3', 0L),
  (m, c) -> named_struct(
    'm1', m.m1 | shiftleft(1L, ascii(c) % 64),
    'm2', m.m2 | (m.m1 & shiftleft(1L, ascii(c) % 64)),
    'm3', m.m3 | (m.m2 & shiftleft(1L, ascii(c) % 64))))"""


def _with_counts(texts: DataFrame) -> DataFrame:
    return texts.select("block", "ord", "key", F.expr(_COUNTED).alias("counts"))


def _looks(side: str) -> list[Column]:
    """What is told of a text before the text itself is fetched."""
    return [
        F.col("block").alias(f"{side}_block"), F.col("ord").alias(f"{side}_ord"),
        F.col("size").alias(f"{side}_size"), F.col("counts").alias(f"{side}_counts"),
    ]


def _differing_counts() -> Column:
    return sum(
        F.bit_count(F.col(f"a_counts.{m}").bitwiseXOR(F.col(f"b_counts.{m}")))
        for m in ("m1", "m2", "m3")
    )


def _edits(length: str, threshold: float) -> str:
    return f"({100 * SCALE - scaled(threshold)} * CAST({length} AS BIGINT) DIV {100 * SCALE})"


def _longest(length: str, threshold: float) -> str:
    """Length of the longest text that can be alike to one of this length."""
    t = scaled(threshold)
    return f"(CAST({length} AS BIGINT) * {200 * SCALE - t} DIV {t})"


def _needed(length: str, threshold: float) -> str:
    """Pieces of which one survives: one more than the edits allowed between a
    text of this length and the longest that can be alike to it."""
    return f"({_edits(f'{length} + {_longest(length, threshold)}', threshold)} + 1)"


def _piece_size(length: str, threshold: float) -> str:
    """As long as enough pieces are left, and half as many again to choose from
    as long as they do not get shorter than PIECE for it."""
    needed = _needed(length, threshold)
    return f"CAST(greatest(1, least({length} DIV {needed}, greatest({PIECE}, 2 * {length} DIV (3 * {needed})))) AS INT)"


def segmentable(threshold: float) -> bool:
    """Above two thirds a text always has more characters than edits allowed."""
    return 3 * scaled(threshold) > 200 * SCALE


def _chunks(texts: DataFrame, threshold: float) -> DataFrame:
    """Each text cut into pieces without overlap; what is left at its end is no piece."""
    return texts.sparkSession.sql(
        f"""
        SELECT block, ord, size, counts, needed, at, xxhash64(block, width, substr(key, at + 1, width)) AS signature
        FROM (SELECT block, ord, key, counts, length(key) AS size, {_needed('length(key)', threshold)} AS needed,
                {_piece_size('length(key)', threshold)} AS width FROM {{texts}})
        LATERAL VIEW explode(CASE WHEN size >= width AND needed > 1 THEN sequence(0, size - width, width) END) AS at""",
        texts=texts,
    )


def _grams(texts: DataFrame, threshold: float) -> DataFrame:
    """All pieces of each text, overlaps included, of every width that a text alike to it may be cut by."""
    t = scaled(threshold)
    shortest = f"greatest(1, CAST((CAST(size AS BIGINT) * {t} + {200 * SCALE - t - 1}) DIV {200 * SCALE - t} AS INT))"
    widths = f"array_distinct(transform(sequence(shortest, CAST(longest AS INT)), other -> {_piece_size('other', threshold)}))"
    return texts.sparkSession.sql(
        f"""
        SELECT block, ord, size, counts, at, xxhash64(block, width, substr(key, at + 1, width)) AS signature
        FROM (SELECT *, {shortest} AS shortest, {_longest('size', threshold)} AS longest
              FROM (SELECT block, ord, key, counts, length(key) AS size FROM {{texts}}))
        LATERAL VIEW explode(CASE WHEN shortest <= longest THEN {widths} END) AS width
        LATERAL VIEW explode(CASE WHEN size >= width THEN sequence(0, size - width) END) AS at""",
        texts=texts,
    )


def _rarest(chunks: DataFrame, grams: DataFrame) -> DataFrame:
    """Of each text the pieces that the fewest pieces of the other side equal.

    Pieces are counted by block; a piece that nothing equals is the rarest of
    all, and may be one of those needed.
    """
    met = grams.groupBy("signature").agg(row_count().alias("often"))
    spots = chunks.join(met, "signature", "left").groupBy("block", "ord", "size", "counts", "needed").agg(
        F.sort_array(
            F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "signature", "at"))
        ).alias("spots")
    )
    chosen = F.filter(
        F.slice("spots", F.lit(1), F.col("needed").cast("int")), lambda spot: spot["often"] > 0
    )
    return spots.select("block", "ord", "size", "counts", F.inline(chosen))


def _rare_characters(texts: DataFrame, threshold: float) -> DataFrame:
    """Prefix filter over characters, for thresholds that segments do not cover.

    Texts that are alike share at least t / (200 - t) of the characters of either,
    counted with repetition. In any one order of (character, how often so far),
    two such texts then share one of the first |a| - that + 1 of each. The order
    here has later repetitions first, as fewer texts have them.
    """
    t = scaled(threshold)
    return texts.sparkSession.sql(
        f"""
        SELECT block, ord, key, counts, xxhash64(block, one.repeated, one.character) AS signature
        FROM (SELECT *, array_sort(transform(sequence(1, length(key)), i -> named_struct(
                'repeated', length(replace(substr(key, 1, i), substr(key, i, 1), '')) - i,
                'character', substr(key, i, 1)))) AS characters,
              ceil(CAST(length(key) AS BIGINT) * {t} / {200 * SCALE - t}) AS shared
            FROM {{texts}})
        LATERAL VIEW explode(slice(characters, 1, CAST(length(key) - shared + 1 AS INT))) AS one""",
        texts=texts,
    )


def _met_on_pieces(earlier: DataFrame, later: DataFrame, threshold: float) -> DataFrame:
    """Candidates (a_..., b_...) that share one of the rarest pieces near its place.

    With D edits and a difference in length of g, a piece is shifted by what is
    inserted before it less what is deleted: at most half of D + g in the one
    direction and of D - g in the other.
    """
    grams = write_out(_grams(earlier, threshold), "grams")
    a = grams.select("signature", F.col("at").alias("a_at"), *_looks("a"))
    b = _rarest(_chunks(later, threshold), grams).select("signature", F.col("at").alias("b_at"), *_looks("b"))
    shift, gap = F.col("a_at") - F.col("b_at"), F.col("a_size") - F.col("b_size")
    limit = allowed_edits(F.col("a_size") + F.col("b_size"), threshold)
    return a.join(b, "signature").filter((2 * shift <= limit + gap) & (-2 * shift <= limit - gap))


def _met_on_characters(earlier: DataFrame, later: DataFrame, threshold: float) -> DataFrame:
    sides = [
        _rare_characters(texts, threshold).withColumn("size", F.length("key")).select("signature", *_looks(side))
        for texts, side in ((earlier, "a"), (later, "b"))
    ]
    return sides[0].join(sides[1], "signature")


def candidates(earlier: DataFrame, later: DataFrame, threshold: float) -> DataFrame:
    """Pairs (block, a_ord, b_ord), each once, that have to be looked at.

    Equal signatures of different pieces only cost a candidate: every pair is
    verified afterwards. Texts stay behind: pieces travel with their row, its
    length and character counts only.
    """
    earlier, later = _with_counts(earlier), _with_counts(later)
    # below two thirds too many edits are allowed for a piece to survive
    met = (_met_on_pieces if segmentable(threshold) else _met_on_characters)(earlier, later, threshold)
    limit = allowed_edits(F.col("a_size") + F.col("b_size"), threshold)
    met = met.filter(
        (F.col("a_block") == F.col("b_block"))
        & (F.col("a_ord") < F.col("b_ord"))
        & (F.abs(F.col("a_size") - F.col("b_size")) <= limit)
        & (_differing_counts() <= limit)
    )
    return met.select(F.col("a_block").alias("block"), "a_ord", "b_ord").distinct()


def similar_pairs(earlier: DataFrame, later: DataFrame, threshold: float) -> DataFrame:
    """Pairs (block, src, dst), src before dst, scoring at or above the threshold.

    Both inputs hold (block, ord, key), keys not empty and distinct per block;
    they are read more than once: hand in written tables. Character counts rule
    out most candidates. Edit distance then brackets the number of insertions and
    deletions from below and above, which settles most of the rest; only pairs in
    between are scored exactly. All of it stays in the JVM.
    """
    met = candidates(earlier, later, threshold)
    a_text = earlier.select("block", F.col("ord").alias("a_ord"), F.col("key").alias("a_key"))
    b_text = later.select("block", F.col("ord").alias("b_ord"), F.col("key").alias("b_key"))
    pairs = met.join(a_text, ["block", "a_ord"]).join(b_text, ["block", "b_ord"])
    sizes = F.length("a_key") + F.length("b_key")
    gap = F.abs(F.length("a_key") - F.length("b_key"))
    distance = F.call_function(
        "levenshtein", F.col("a_key"), F.col("b_key"), F.col("limit").cast("int")
    )
    pairs = pairs.withColumn("limit", allowed_edits(sizes, threshold))
    pairs = pairs.withColumn("distance", distance).filter(F.col("distance") >= 0)
    alike = F.when(2 * F.col("distance") - gap <= F.col("limit"), True).otherwise(
        sizes - 2 * lcs_length(F.col("a_key"), F.col("b_key")) <= F.col("limit")
    )
    return pairs.filter(alike).select(
        "block", F.col("a_ord").alias("src"), F.col("b_ord").alias("dst")
    )


# ------------------------------------------------------------------- ordering


def _number_in_block(keys: DataFrame) -> DataFrame:
    """Position of each key in its block, though a block may fill many tasks.

    Range partitioning by block and order cuts a large block into runs; a key's
    position is its place in the run plus the size of the runs before it.
    """
    runs = keys.repartitionByRange("block", "first").withColumn("run", F.spark_partition_id())
    # written out: sampling the ranges again could cut the runs elsewhere
    runs = write_out(runs, "runs")
    before = Window.partitionBy("block").orderBy("run").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = runs.groupBy("block", "run").agg(F.count("*").alias("n"))
    offsets = sizes.select(
        "block", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    place = F.row_number().over(Window.partitionBy("block", "run").orderBy("first"))
    return (
        runs.withColumn("place", place)
        .join(offsets, ["block", "run"])
        .withColumn("ord", F.col("offset") + F.col("place"))
        .drop("run", "place", "offset")
    )


def _batch_of(position: Column, first_batch: int, growth: int) -> Column:
    later = F.floor(F.log(float(growth), (position - 1) / F.lit(float(first_batch)))) + 1
    return F.when(position <= first_batch, F.lit(0)).otherwise(later).cast("int")


# ------------------------------------------------------------------- decision


@dataclass
class Settling:
    """What a settlement took: batches, rounds over large components, and labels passed on to find these."""

    batches: int = 0
    rounds: int = 0
    label_steps: int = 0


def _replayed(group: pd.DataFrame) -> pd.DataFrame:
    """The rule on edges that hang together, in order."""
    lost = set()
    for src, dst in sorted(zip(group["src"].tolist(), group["dst"].tolist())):
        if src not in lost:
            lost.add(dst)
    return pd.DataFrame({"block": group["block"].iloc[0], "ord": sorted(lost)}).astype({"ord": "int64"})


_GONE = "block string, ord long"


def _components(edges: DataFrame, told: Settling) -> DataFrame:
    """(block, ord, label): rows with an edge, labelled by the least row of their component.

    A step gives each row the least label of its neighbours, and then the label
    of that label's row; so labels travel twice as far with every step.
    """
    both = edges.select("block", F.col("src").alias("ord"), F.col("dst").alias("other")).union(
        edges.select("block", "dst", "src")
    )
    both = write_out(both, "neighbours")
    labels = both.groupBy("block", "ord").agg(F.least("ord", F.min("other")).alias("label"))
    changed = 1
    while changed:
        labels = write_out(labels, "labels")
        told.label_steps += 1
        near = both.join(labels.select("block", F.col("ord").alias("other"), "label"), ["block", "other"])
        least = near.groupBy("block", "ord").agg(F.min("label").alias("near"))
        stepped = labels.join(least, ["block", "ord"]).select(
            "block", "ord", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        stepped = write_out(stepped, "label-step")
        onward = stepped.select("block", F.col("ord").alias("label"), F.col("label").alias("onward"))
        jumped = stepped.join(onward, ["block", "label"], "left").select(
            "block", "ord", "old", F.least("label", "onward").alias("label")
        )
        labels, changed = write_out_with(jumped, "labels", F.count_if(F.col("label") != F.col("old")))
        labels = labels.drop("old")
    return labels


def _in_rounds(edges: DataFrame, told: Settling) -> DataFrame:
    """Rows lost, round by round; one written table a round."""
    gone = []
    left = 1
    while left:
        told.rounds += 1
        beaten = edges.select("block", F.col("dst").alias("src")).distinct()
        stay = edges.select("block", "src").distinct().join(
            beaten, ["block", "src"], "left_anti"
        )
        lost = edges.join(stay, ["block", "src"], "left_semi").select("block", "dst").distinct()
        lost = write_out(lost.withColumnRenamed("dst", "ord"), "lost")
        gone.append(lost)
        edges, left = write_out_with(
            edges.join(lost.withColumnRenamed("ord", "src"), ["block", "src"], "left_anti").join(
                lost.withColumnRenamed("ord", "dst"), ["block", "dst"], "left_anti"
            ),
            "edges",
            row_count(),
        )
    return functools.reduce(DataFrame.unionByName, gone)


def first_wins(edges: DataFrame, replayed: int = REPLAYED, told: Settling | None = None) -> DataFrame:
    """Rows (block, ord) removed when earlier rows win, given all edges
    (block, src, dst) between rows not yet decided.

    The number of jobs does not depend on how long chains are, unless more than
    `replayed` edges hang together.
    """
    told = told or Settling()
    edges, n_edges = write_out_with(edges.distinct(), "edges", row_count())
    if not n_edges:
        return edges.select("block", F.col("dst").alias("ord"))
    sizes = edges.groupBy("block").agg(row_count().alias("n"))
    large, n_large = write_out_with(sizes.filter(F.col("n") > replayed), "large-blocks", row_count())
    if not n_large:
        return edges.groupBy("block").applyInPandas(_replayed, _GONE)
    few = edges.join(large, "block", "left_anti").groupBy("block").applyInPandas(_replayed, _GONE)
    crowded = write_out(edges.join(large.select("block"), "block", "left_semi"), "crowded-blocks")
    labels = _components(crowded, told)
    crowded = write_out(
        crowded.join(labels.select("block", F.col("ord").alias("src"), "label"), ["block", "src"]), "labelled-edges"
    )
    grown, n_grown = write_out_with(
        crowded.groupBy("block", "label").agg(row_count().alias("n")).filter(F.col("n") > replayed).drop("n"),
        "large-components",
        row_count(),
    )
    few = few.unionByName(
        crowded.join(grown, ["block", "label"], "left_anti")
        .groupBy("block", "label")
        .applyInPandas(_replayed, _GONE)
    )
    if n_grown:
        few = few.unionByName(_in_rounds(crowded.join(grown, ["block", "label"], "left_semi").drop("label"), told))
    return few


def match_keys(df: DataFrame, block_by: str) -> DataFrame:
    """Distinct (block, key) of the rows to compare, with their first row."""
    return (
        df.filter(~has_any_id(df.columns) & F.col(block_by).isNotNull())
        .select(
            F.col(block_by).cast("string").alias("block"),
            match_key(df.columns).alias("key"),
            processing_order(df.columns).alias("first"),
        )
        .groupBy("block", "key")
        .agg(F.min("first").alias("first"))
    )


def settle(
    keys: DataFrame,
    threshold: float,
    first_batch: int = FIRST_BATCH,
    growth: int = BATCH_GROWTH,
    told: Settling | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All keys numbered, and those that stay; both (block, ord, key, row_id)."""
    told = told or Settling()
    numbered = _number_in_block(keys).select(
        "block",
        "ord",
        "key",
        F.col(f"first.{ROW_ID}").alias(ROW_ID),
        _batch_of(F.col("ord"), first_batch, growth).alias("batch"),
    )
    numbered, last = write_out_with(numbered, "keys", F.max("batch"))
    everything = numbered.drop("batch")
    kept = None
    for batch in range((last or 0) + 1):
        told.batches += 1
        current = numbered.filter(F.col("batch") == batch).drop("batch")
        if kept is not None:
            taken = similar_pairs(kept, current, threshold)
            taken = taken.select("block", F.col("dst").alias("ord")).distinct()
            current = write_out(current.join(taken, ["block", "ord"], "left_anti"), "current")
        removed = first_wins(similar_pairs(current, current, threshold), told=told)
        stays = write_out(current.join(removed, ["block", "ord"], "left_anti"), "kept")
        kept = stays if kept is None else kept.unionByName(stays)
    return everything, kept


def dedup_fuzzy(
    df: DataFrame,
    block_by: str = "zip_code",
    threshold: float = 92,
    first_batch: int = FIRST_BATCH,
    growth: int = BATCH_GROWTH,
    told: Settling | None = None,
) -> DataFrame:
    """Drop the id-less rows that an earlier row of their block is alike to.

    ``df`` is read more than once: hand in a written table. ``told`` is filled
    with what the settlement took.
    """
    if block_by not in df.columns:
        return df
    compared = ~has_any_id(df.columns) & F.col(block_by).isNotNull()
    _, kept = settle(match_keys(df, block_by), threshold, first_batch, growth, told)
    return df.filter(~compared).unionByName(
        df.filter(compared).join(kept.select(ROW_ID), ROW_ID, "left_semi").select(*df.columns)
    )


def fuzzy_matches(df: DataFrame, block_by: str = "zip_code", threshold: float = 92) -> DataFrame:
    """Which kept row took each removed key: (block, removed, kept, score).

    One line per removed key with the earliest kept row it is alike to, so the
    result grows with the keys and never with their pairs.
    """
    keys, kept = settle(match_keys(df, block_by), threshold)
    removed = keys.join(kept.select("block", "ord"), ["block", "ord"], "left_anti")
    taker = similar_pairs(kept, removed, threshold).groupBy("block", "dst").agg(
        F.min("src").alias("src")
    )
    by = kept.select("block", F.col("ord").alias("src"), F.col("key").alias("kept_key"),
                     F.col(ROW_ID).alias("kept_row"))
    of = removed.select("block", F.col("ord").alias("dst"), F.col("key").alias("removed_key"),
                        F.col(ROW_ID).alias("removed_row"))
    return taker.join(of, ["block", "dst"]).join(by, ["block", "src"]).select(
        "block",
        "removed_row",
        "kept_row",
        ratio(F.col("removed_key"), F.col("kept_key")).alias("score"),
    )


def resolve_entities(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    exact = write_out(dedup_exact(df), "exact")
    return dedup_fuzzy(exact, settings.block_by, settings.fuzzy_threshold)
