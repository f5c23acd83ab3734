"""Phrase collocations: counts by double-array tries of candidates, level by level.

Texts are written once as sequences of word numbers, each batch with its own dictionary of 64-bit word symbols (hashes of
language and word), so no dictionary of the corpus is needed anywhere. A phrase can only be frequent if what it begins with
is: candidates of k + 1 words are frequent phrases of k words and the word after them. Candidates of a level go out as
double-array tries of at most SHARD phrases, a pass over the sequences for each; in a pass all positions of a batch advance
through the trie together, states that accept are counted by their numbers, and the counts of batches are summed. The same
walk tells which words follow, for the next level.

Words of one language with equal symbols would count as one. With 10^10 words in a language and 10^7 in candidates, the odds
that a candidate's word has such a twin are below one in a hundred.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listora.llm.arrow_batches import pieces
from listora.llm.double_array import DoubleArray
from listora.llm.key_counts import pack, unpack
from listora.session import row_count, write_out, write_out_with

LONGEST = 5  # words in a phrase
LEAST = 100  # occurrences of a candidate
TOP = 2000  # phrases of a language in the report
TOGETHER = 4 << 20  # bytes of text that are numbered together
ROWS = 1 << 15  # phrases in an Arrow batch
SHARD = 200_000  # phrases of a trie, some 20 MB at most
NO_LANGUAGE = "und"

_FOLD = bytearray(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
_END = b"."  # between pieces; a separator, so never part of a word
for _code in (*b".,;:!?", *range(0x0A, 0x0E)):
    _FOLD[_code] = ord("\n")
_FOLD = bytes(_FOLD)


class _Numbers(dict):
    """Numbers of words in order of appearance; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).replace(b"\n", b" . ").split()


_SEQUENCES = "lang string, n_words long, n_distinct long, words binary, words_bytes long, symbols binary, counts binary, n_ids long, ids binary"


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each language of some texts together: its words, their symbols and counts, and the texts as word numbers."""
    for batch in batches:
        for part in pieces(batch, "text", TOGETHER, len(batch)):
            yield _numbered(part)


def _numbered(batch: pa.RecordBatch) -> pa.RecordBatch:
    numbers: dict[str, _Numbers] = {}
    parts: dict[str, list[np.ndarray]] = {}
    for piece in pieces(batch, "text"):
        for lang, text in zip(piece.column("lang").to_pylist(), piece.column("text"), strict=True):
            known = numbers.setdefault(lang, _Numbers())
            tokens = _tokens(text.as_py())
            tokens.append(_END)
            parts.setdefault(lang, []).append(np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens)))
    rows = []
    for lang, known in numbers.items():
        ids = np.concatenate(parts.pop(lang))
        counts = np.bincount(ids, minlength=len(known)).astype(np.int64)
        counts[0] = 0
        seed = xxhash.xxh64_intdigest(lang.encode())
        symbols = np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in known), np.uint64, len(known))
        told = b"\n".join(known)  # a separator too
        rows.append((lang, int(counts.sum()), len(known), pa.compress(told, codec="zstd", asbytes=True), len(told), pack(symbols), pack(counts), len(ids), pack(ids)))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
    names = [field.split()[0] for field in _SEQUENCES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names=names)


def sequences(docs: DataFrame) -> DataFrame:
    """The texts as word numbers, written to the shared folder; a null text has no words, a null lang is `und`."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), "text")
    return write_out(rows.mapInArrow(_sequences, _SEQUENCES), "phrase-sequences")


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            told = pa.decompress(row["words"], decompressed_size=row["words_bytes"], codec="zstd", asbytes=True)
            words = pa.array(told.split(b"\n")[1:], pa.binary()).cast(pa.string())
            symbols = unpack(row["symbols"], row["n_distinct"], np.uint64)[1:].view(np.int64)
            counts = unpack(row["counts"], row["n_distinct"], np.int64)[1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["lang"]] * len(words), pa.string()), words, pa.array(symbols), pa.array(counts)], names=["lang", "word", "symbol", "n"]
            )


def frequent_words(texts: DataFrame, least: int) -> DataFrame:
    """lang, word, symbol, n of words that occur `least` times or more in a language."""
    rows = texts.select("lang", "words", "words_bytes", "n_distinct", "symbols", "counts").mapInArrow(_words, "lang string, word string, symbol long, n long")
    return rows.groupBy("lang", "word", "symbol").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


_COUNTED = "phrase array<long>, n long, counted boolean"


def _phrase_rows(symbols: np.ndarray, n: np.ndarray, counted: bool) -> Iterator[pa.RecordBatch]:
    """Small batches: the JVM holds each as a whole."""
    for low in range(0, len(n), ROWS):
        part = symbols[low : low + ROWS]
        size, width = part.shape
        offsets = pa.array(np.arange(size + 1, dtype=np.int32) * width)
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(part).view(np.int64).ravel()))
        yield pa.RecordBatch.from_arrays(
            [lists, pa.array(n[low : low + ROWS], pa.int64()), pa.array(np.full(size, counted))], names=["phrase", "n", "counted"]
        )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield unpack(row["symbols"], row["n_distinct"], np.uint64), unpack(row["ids"], row["n_ids"], np.int32)
            pa.default_memory_pool().release_unused()  # workers live on after their task


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbouring words of each batch with their counts."""
    for symbols, ids in _unpacked(batches):
        both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        pairs, n = np.unique(ids[both].astype(np.int64) << 32 | ids[both + 1], return_counts=True)
        yield from _phrase_rows(np.stack([symbols[pairs >> 32], symbols[pairs & 0xFFFFFFFF]], axis=1), n, False)


def _walked(trie: Broadcast, onward: bool):
    """Counts of a trie's phrases in each batch, and with `onward` of the phrases one word longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = DoubleArray.of(trie.value)
        for symbols, ids in _unpacked(batches):
            numbers = known.symbols(symbols)
            numbers[0] = 0
            at, state = known.walk(numbers[ids])
            counts = np.bincount(state, minlength=len(known.check))
            seen = np.flatnonzero(counts)
            yield from _phrase_rows(known.phrases[known.phrase_of[seen]].reshape(-1, known.depth), counts[seen], True)
            if onward:
                inside = at + known.depth < len(ids)
                at, state = at[inside], state[inside]
                follower = ids[at + known.depth].astype(np.int64)
                pairs, n = np.unique((state[follower > 0] << 32) | follower[follower > 0], return_counts=True)
                longer = np.concatenate([known.phrases[known.phrase_of[pairs >> 32]], symbols[pairs & 0xFFFFFFFF][:, None]], axis=1)
                yield from _phrase_rows(longer.reshape(-1, known.depth + 1), n, False)

    return run


def _trie(candidates: DataFrame, depth: int) -> DoubleArray:
    """Of one shard's candidates; at most about SHARD phrases come to the driver at once."""
    table = candidates.select(*[F.col("phrase")[i].alias(f"w{i}") for i in range(depth)]).toArrow()
    columns = [column.to_numpy().view(np.uint64) for column in table.columns]
    return DoubleArray(np.stack(columns, axis=1) if len(table) else np.empty((0, depth), np.uint64))


def frequent_phrases(texts: DataFrame, least: int = LEAST, longest: int = LONGEST, shard: int = SHARD) -> list[DataFrame]:
    """(phrase, n) of phrases of 2 words, 3 words and so on that occur `least` times or more; `phrase` is a list of symbols."""
    spark = texts.sparkSession
    numbers = texts.select("symbols", "n_distinct", "ids", "n_ids")

    def frequent(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
        enough = rows.groupBy("phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        return write_out_with(enough, name, row_count())

    found = []
    candidates, size = frequent(numbers.mapInArrow(_pairs, _COUNTED), "phrase-candidates-2")
    for depth in range(2, longest + 1):
        n_shards = -(-size // shard)
        passes = []
        for part in range(n_shards):
            mine = candidates.filter(F.pmod(F.xxhash64("phrase"), F.lit(n_shards)) == part)
            trie = spark.sparkContext.broadcast(_trie(mine, depth).arrays())
            passes.append(write_out(numbers.mapInArrow(_walked(trie, depth < longest), _COUNTED), f"phrases-{depth}"))
            trie.destroy()
        if not passes:
            break
        rows = passes[0]
        for more in passes[1:]:
            rows = rows.unionByName(more)
        found.append(frequent(rows.filter("counted"), f"phrases-{depth}")[0])
        candidates, size = frequent(rows.filter("NOT counted"), f"phrase-candidates-{depth + 1}")
    return found


def _long(name: str) -> Column:
    return F.col(name).cast("decimal(18,0)")


def _scored(phrases: DataFrame, parts: DataFrame, totals: DataFrame) -> DataFrame:
    """phrase, lang, a, l, r, n, score of the lowest-scoring cut; ties to the earliest."""
    cut = phrases.select("phrase", "lang", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k")).select(
        "phrase", "lang", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("left"), F.expr("slice(phrase, k + 1, size(phrase) - k)").alias("right")
    )
    left = parts.select(F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = parts.select(F.col("phrase").alias("right"), F.col("n").alias("r"))
    score = F.expr("(CAST(1000 AS DECIMAL(4, 0)) * _a * _n) div (_l * _r)")
    told = (
        cut.join(left, "left").join(right, "right").join(totals, "lang")
        .withColumns({"_a": _long("a"), "_n": _long("n"), "_l": _long("l"), "_r": _long("r")})
        .select("phrase", "lang", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    )
    return told.groupBy("phrase", "lang", "a", "n").agg(F.min("cut").alias("cut")).select(
        "phrase", "lang", "a", "n", "cut.l", "cut.r", "cut.score"
    )


def _held(phrases: DataFrame) -> DataFrame:
    """phrase, most: for what lies inside longer candidates, the largest count of these."""
    spots = F.expr(
        "flatten(transform(sequence(2, size(phrase) - 1), w -> transform(sequence(1, size(phrase) - w + 1), i -> slice(phrase, i, w))))"
    )
    inside = phrases.filter(F.size("phrase") > 2).select(F.explode(spots).alias("phrase"), "a")
    return inside.groupBy("phrase").agg(F.max("a").alias("most"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `top` phrases of 2 to `longest` words of each language.

    A phrase lies within a piece of a text and occurs `least` times or more (a). n is the number of words of the language,
    l and r are the counts of the two parts of the cut with the lowest floor(1000 * a * n / (l * r)), the earliest of
    equals. Phrases that lie inside a longer one of the same count are left out. Order: score and a descending, phrase in
    byte order. Copies and repeated rows count again. A null text is empty, a null lang is `und`. Texts may be of any
    length that fits a task; columns other than text and lang play no part, whatever their names. An empty table, or one
    without frequent phrases, gives no rows.
    """
    texts = sequences(docs)
    words = write_out(frequent_words(texts, least), "phrase-words")
    totals = texts.groupBy("lang").agg(F.sum("n_words").alias("n"))
    levels = frequent_phrases(texts, least, longest, shard)
    parts = words.select(F.array("symbol").alias("phrase"), "n")
    for level in levels:
        parts = parts.unionByName(level)
    placed = parts.filter(F.size("phrase") > 1).select(F.col("phrase"), F.col("n").alias("a"), F.posexplode("phrase").alias("place", "symbol"))
    spelt = (
        placed.join(words.select("symbol", "lang", "word"), "symbol")
        .groupBy("phrase", "a", "lang")
        .agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("_words"))
        .select("phrase", "a", "lang", F.array_join(F.transform("_words", lambda spot: spot["word"]), " ").alias("told"))
    )
    phrases = write_out(spelt, "phrases-told")
    kept = phrases.join(_held(phrases), "phrase", "left").filter(F.col("most").isNull() | (100 * F.col("most") < 100 * F.col("a")))
    scored = _scored(kept.select("phrase", "lang", "a"), parts, totals).join(kept.select("phrase", "told"), "phrase")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "told")
    return (
        scored.withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", F.col("told").alias("phrase"), "a", "l", "r", "n", "score")
    )
