"""Spelling variants: words one edit apart, by dense tiles of their common prefixes and suffixes.

Two distinct words of m and m code points are one replacement apart, and two of m and m + 1 one insertion, if and only if
their common prefix and common suffix together reach the longer length less one. Tiles are groups of words of m and m + 1
code points that share all but a third of the shorter length: what comes before the third, and what comes after it. Within
a tile, words lie in matrices of code points, padded on the right and again on the left, and all pairs of the tile are
compared at once. Tiles above TILE words are dealt anew by single positions instead of thirds, and those still above it in
blocks of hashes, pair of blocks by pair of blocks; so no task meets a group of unbounded size, and no pair is lost.
A pair is reported in one tile only: the one that holds the first position at which its words part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listora.session import row_count, write_out, write_out_with

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5  # a form is so many times as frequent as its variant
TILE = 256  # words of a tile that are compared in one matrix
PARTS = 3  # of a word; the edit lies in one of them
CELLS = 1 << 22  # pairs that are compared at once

_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))  # of UTF-8, where these bytes are A-Z and a-z alone


def _counted(deleting: int | None):
    runs_of = re.compile(f"{LETTERS}{{{LEAST_LENGTH},}}")  # greedy, so a match is a whole run

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[str] = Counter()
            for doc_id, text in zip(batch.column("_id").to_pylist(), batch.column("text"), strict=True):
                found = Counter(runs_of.findall((text.as_py() or "").encode().translate(_FOLD).decode()))
                if deleting and doc_id is not None:
                    before = zlib.crc32(f"{doc_id}:".encode())
                    cut = [word for word in found if zlib.crc32(word.encode(), before) % deleting == 0]
                    for word in cut:
                        at = zlib.crc32(word.encode(), before) % len(word)
                        total[word[:at] + word[at + 1 :]] += found.pop(word)
                total.update(found)
            words = [word for word in total if len(word) >= LEAST_LENGTH]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([total[word] for word in words], pa.int64())], names=["word", "n"]
            )

    return run


def word_counts(docs: DataFrame, deleting: int | None = 199) -> DataFrame:
    """word, n: runs of letters of all texts, A-Z folded, with their counts.

    With `deleting`, runs whose crc32 of ``<doc_id>:<run>`` it divides lose one code point, as the contract of the query
    has it; None leaves them whole. A null text has no words; a null doc_id deletes nothing. Runs too short to be words
    with or without the deletion are left out before they are counted, and counts of an Arrow batch are summed before the
    shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("_id"), "text")
    return rows.mapInArrow(_counted(deleting), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _key(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _tiles(words: DataFrame) -> DataFrame:
    """m, low, high, word, n, key: each word in the tiles of thirds it belongs to, as one of m or of m + 1 code points."""
    size = F.length("word")
    parts = F.array(*[
        F.struct(
            F.floor(F.col("m") * part / PARTS).cast("int").alias("low"), F.floor(F.col("m") * (part + 1) / PARTS).cast("int").alias("high")
        )
        for part in range(PARTS)
    ])
    return (
        words.withColumn("m", F.explode(F.array(size - 1, size)))
        .filter(F.col("m") >= 1)
        .withColumn("_part", F.explode(parts))
        .select("m", F.col("_part.low").alias("low"), F.col("_part.high").alias("high"), "word", "n")
        .filter("low < high")
        .withColumn("key", _around())
    )


def _around() -> Column:
    """Key of what a word has before and after the part of the tile."""
    return _key(F.col("m"), F.col("low"), F.col("high"), F.expr("left(word, low)"), F.expr("right(word, m - high)"))


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of tiles that fit, and rows of those that do not, with `size`."""
    large = write_out(rows.groupBy("key").agg(row_count().alias("size")).filter(F.col("size") > TILE), "large-tiles")
    return rows.join(large, "key", "left_anti"), rows.join(large, "key")


def _dealt(words: DataFrame) -> DataFrame:
    """key, m, low, high, word, n, side: tiles of bounded size. Words of side 0 and 1 are held against each other, those of side -1 among themselves."""
    fit, large = _split(_tiles(words))
    single = (
        large.drop("size", "key")
        .withColumn("low", F.explode(F.sequence("low", F.col("high") - 1)))
        .withColumn("high", F.col("low") + 1)
        .withColumn("key", _around())
    )
    fit_too, blocks = _split(single)
    n = F.ceil(F.col("size") * 2 / TILE).cast("int")
    pairs = (
        blocks.withColumn("_n", n)
        .withColumn("_own", F.pmod(F.xxhash64(F.lit("block"), "word"), "_n").cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .withColumn("side", F.when(F.col("_own") == F.col("_other"), F.lit(-1)).otherwise((F.col("_own") > F.col("_other")).cast("int")))
        .withColumn("key", _key(F.col("key"), F.least("_own", "_other"), F.greatest("_own", "_other")))
    )
    columns = ["key", "m", "low", "high", "word", "n", "side"]
    whole = [part.withColumn("side", F.lit(-1)).select(columns) for part in (fit, fit_too)]
    return whole[0].unionByName(whole[1]).unionByName(pairs.select(columns))


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Matrices of code points, padded on the right and on the left, one row a word."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    width = int(sizes.max())
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left, right = np.zeros((len(words), width), np.uint32), np.zeros((len(words), width), np.uint32)
    left[row, place] = flat
    right[row, place + np.repeat(width - sizes, sizes)] = flat
    return left, right[:, ::-1]


def _common(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Common prefix lengths of stacks (g, s, width) of matrices, all pairs of a stack: (g, s, s)."""
    alive = np.ones((one.shape[0], one.shape[1], other.shape[1]), dtype=bool)
    found = np.zeros(alive.shape, dtype=np.uint8 if one.shape[2] < 256 else np.int32)
    for place in range(one.shape[2]):
        a, b = one[:, :, place, None], other[:, None, :, place]
        alive &= a == b
        alive &= a != 0
        if not alive.any():
            break
        found += alive
    return found


def _near_in_tiles(tiles: pd.DataFrame) -> pa.RecordBatch:
    """Pairs of near words of whole tiles, ordered by key."""
    keys = tiles["key"].to_numpy()
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(first, len(keys)))
    words = tiles["word"].tolist()
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    m, low, high, side = (tiles[name].to_numpy() for name in ("m", "low", "high", "side"))
    lefts, rights = [], []
    stack = np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)
    for power in np.unique(stack[sizes > 1]):
        chosen = np.flatnonzero((stack == power) & (sizes > 1))
        chosen = chosen[np.argsort(m[first[chosen]], kind="stable")]  # tiles of about one width are stacked
        edge = 1 << int(power)
        step = max(1, CELLS // (edge * edge))
        for start in range(0, len(chosen), step):
            group = chosen[start : start + step]
            rows = first[group][:, None] + np.arange(edge)[None, :]
            real = np.arange(edge)[None, :] < sizes[group][:, None]
            rows = np.where(real, rows, first[group][:, None])
            flat = rows.ravel()
            left, right = _code_points([words[i] for i in flat])
            left, right = left.reshape(*rows.shape, -1), right.reshape(*rows.shape, -1)
            prefix = _common(left, left).astype(np.int32)
            suffix = _common(right, right)
            size, shorter = length[rows], m[rows[:, 0]]
            longer = np.maximum(size[:, :, None], size[:, None, :])
            near = prefix + suffix >= longer - 1
            near &= np.minimum(size[:, :, None], size[:, None, :]) == shorter[:, None, None]
            near &= np.abs(size[:, :, None] - size[:, None, :]) <= 1
            near &= np.triu(np.ones((edge, edge), dtype=bool), 1)[None]
            near &= real[:, :, None] & real[:, None, :]
            apart = np.minimum(prefix, shorter[:, None, None] - 1)  # the pair's own position, in one tile only
            near &= (apart >= low[rows[:, 0]][:, None, None]) & (apart < high[rows[:, 0]][:, None, None])
            sides = side[rows]
            near &= (sides[:, :, None] == -1) | (sides[:, :, None] != sides[:, None, :])
            g, i, j = np.nonzero(near)
            lefts.append(rows[g, i])
            rights.append(rows[g, j])
    none = [np.empty(0, np.int64)]
    left, right = np.concatenate(lefts or none), np.concatenate(rights or none)
    one, other = np.concatenate([left, right]), np.concatenate([right, left])
    told, count = np.array(words, dtype=object), tiles["n"].to_numpy()
    return pa.RecordBatch.from_arrays(
        [pa.array(told[one], pa.string()), pa.array(count[one], pa.int64()), pa.array(told[other], pa.string()), pa.array(count[other], pa.int64())],
        names=["word", "n", "near", "near_n"],
    )


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by key; a tile that a batch does not end waits for the next."""
    waiting: pd.DataFrame | None = None
    for batch in batches:
        rows = batch.to_pandas()
        if waiting is not None:
            rows = pd.concat([waiting, rows], ignore_index=True)
        if not len(rows):
            continue
        last = rows["key"].to_numpy() == rows["key"].iloc[-1]
        waiting, rows = rows[last], rows[~last].reset_index(drop=True)
        if len(rows):
            yield _near_in_tiles(rows)
    if waiting is not None:
        yield _near_in_tiles(waiting.reset_index(drop=True))


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: each ordered pair of words of the table (word, n) one edit apart, once.

    `word` has to be unique. Null and empty words take no part. An empty table gives no rows.
    """
    tiles = _dealt(words.select("word", "n").filter(F.length("word") > 0))
    in_order = tiles.repartition("key").sortWithinPartitions("key")
    return in_order.mapInArrow(_near, "word string, n long, near string, near_n long")


def _rooted(forms: DataFrame) -> DataFrame:
    """word, root of the table (word, form): chains are halved until none has a second link.

    Each link multiplies the count by TIMES at least, so chains have less than 28 links and five rounds end them.
    """
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links, moved = write_out_with(
            links.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "spelling-roots", F.count_if("_moved"),
        )
        links = links.drop("_moved")
        if not moved:
            return links


def spelling_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of the table (word, n); words have to be unique.

    A word's form is its near word of largest n (ties: the smaller in code-point order) if that n is `times` the word's at
    least, else null; `root` follows forms to the last, and is the word itself without one. An empty table gives no rows.
    """
    words = write_out(words.select("word", "n"), "spelling-words")
    largest = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))
    best = near_words(words).groupBy("word").agg(row_count().alias("n_near"), F.min(largest).alias("_best"))
    told = write_out(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("_best.near").alias("_near"), (-F.col("_best.less")).alias("_near_n")
        ),
        "spelling-links",
    )
    has_form = F.col("_near_n") >= F.col("n") * times
    told = told.select(
        "word", "n", "n_near", F.when(has_form, F.col("_near")).alias("form"), F.when(has_form, F.col("_near_n")).alias("form_n")
    )
    roots = _rooted(told.filter(F.col("form").isNotNull()))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, least_count: int = LEAST_COUNT, deleting: int | None = 199) -> DataFrame:
    """`spelling_variants` of the words of all whole texts that occur `least_count` times or more.

    Null and empty texts have no words; copies of a row count again; columns other than doc_id and text play no part,
    whatever their names. Texts may be of any length: their runs leave the row one by one. An empty table gives no rows.
    """
    return spelling_variants(word_counts(docs, deleting).filter(F.col("n") >= least_count))
