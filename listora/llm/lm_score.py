"""LM scoring by context-tree weighting, beside a unigram base score.

A text is scored as its words in lower case (A-Z), one space between them and one end sign: the same event as the tokens
of the base score. Training documents give counts of six-byte keys (five bytes of context and the byte) and of tokens;
both are summed bucket by bucket, so neither the model nor the vocabulary is ever in one place. Only the nodes with
contexts of up to one byte, at most 65,535 whatever the corpus, reach the driver.

Scoring asks the other way round: each batch of documents sends its distinct keys and tokens to their buckets once and
gets probabilities and counts back. A bucket takes in a bounded number of batches at a time (a shard).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listora.llm import context_tree as tree
from listora.llm.arrow_batches import pieces
from listora.llm.distinct_texts import dealt_texts, merged_copies, text_key, total_bytes
from listora.llm.hashing import mixed, words
from listora.llm.key_counts import pack, pack_keys, summed, unpack, unpack_keys
from listora.session import write_out

BATCH_BYTES = 16 << 20  # of text
SHARD = 64  # batches a bucket takes in at a time
END = ord("\n")  # never inside a word

_BYTES, _WORDS = 0, 1
_FOLD = bytes(range(256)).translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
_END_TOKEN = mixed(np.array([END], dtype=np.uint64))[0]
_COUNT_ROWS = "kind int, bucket long, shard long, batch long, n long, keys binary, counts binary"
_COUNT_TYPES = {
    "kind": pa.int32(), "bucket": pa.int64(), "shard": pa.int64(), "batch": pa.int64(), "n": pa.int64(),
    "keys": pa.binary(), "counts": pa.binary(),
}


def byte_sequence(text: bytes) -> bytes:
    """What is scored, after a context of end signs."""
    return bytes([END]) * tree.DEPTH + b" ".join(text.translate(_FOLD).split()) + bytes([END])


def _sequences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all bytes that are scored, and how many each text has."""
    parts = [byte_sequence(text) for text in texts]
    keys = tree.keys_of(np.frombuffer(b"".join(parts), dtype=np.uint8))
    sizes = np.array([len(part) for part in parts])
    starts = np.cumsum(sizes) - sizes
    scored = np.ones(len(keys) + tree.DEPTH, dtype=bool)
    for i in range(tree.DEPTH):
        scored[starts + i] = False
    return keys[scored[tree.DEPTH :]], sizes - tree.DEPTH


def _tokens(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, end tokens last, and the text each belongs to."""
    found = words(piece.column("text"), lower=True)
    n = len(piece)
    return np.concatenate((found.hashes, np.full(n, _END_TOKEN))), np.concatenate((found.owner(), np.arange(n)))


def _bucket_of(kind: int, keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Keys with the same two nearest bytes share a bucket; tokens go by their hash."""
    spread = mixed(keys >> np.uint64(8 * (tree.DEPTH - tree.SPLIT + 1))) if kind == _BYTES else keys
    return ((spread >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def _bucket_rows(kind: int, keys: np.ndarray, counts: np.ndarray | None, n_buckets: int, batch: int) -> Iterator[tuple]:
    buckets = _bucket_of(kind, keys, n_buckets)
    order = np.argsort(buckets, kind="stable")  # keys stay in order
    edges = np.flatnonzero(np.diff(buckets[order], prepend=-1, append=-1))
    for low, high in zip(edges, edges[1:], strict=False):
        rows = order[low:high]
        told = None if counts is None else pack(counts[rows].astype(np.uint32 if counts.max() < 1 << 32 else np.uint64))
        yield (kind, int(buckets[rows[0]]), batch // SHARD, batch, len(rows), pack_keys(keys[rows]), told)


def _table(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.table({name: pa.array(column, kind) for (name, kind), column in zip(kinds.items(), columns, strict=True)})


def _counts(data: bytes, n: int) -> np.ndarray:
    try:
        return unpack(data, n, np.uint32)
    except OSError:
        return unpack(data, n, np.uint64)


def _trained(n_buckets: int, flush_bytes: int):
    """Counts of keys and tokens of training texts, so much text at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, number = 0, 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                weights = piece.column("weight").to_numpy()
                keys, sizes = _sequences([x.as_py().encode() for x in piece.column("text")])
                tokens, owner = _tokens(piece)
                held.append((*summed(keys, np.repeat(weights, sizes)), *summed(tokens, weights[owner])))
                size += len(keys)
                if size >= flush_bytes:
                    yield from _table(_flushed(held, n_buckets, number), _COUNT_TYPES).to_batches()
                    held, size, number = [], 0, number + 1
        if held:
            yield from _table(_flushed(held, n_buckets, number), _COUNT_TYPES).to_batches()

    return run


def _flushed(held: list[tuple], n_buckets: int, number: int) -> list[tuple]:
    rows: list[tuple] = []
    for kind in (_BYTES, _WORDS):
        keys, counts = summed(*(np.concatenate([x[2 * kind + i] for x in held]) for i in (0, 1)))
        rows.extend(_bucket_rows(kind, keys, counts, n_buckets, number))
    return rows


def _merged(key: tuple, table: pa.Table) -> pa.Table:
    """One row for a group of rows: keys in order and summed counts."""
    rows = list(zip(table["n"].to_pylist(), table["keys"].to_pylist(), table["counts"].to_pylist(), strict=True))
    keys, counts = summed(
        np.concatenate([unpack_keys(keys, n) for n, keys, _ in rows]),
        np.concatenate([_counts(counts, n).astype(np.int64) for n, _, counts in rows]),
    )
    wide = counts.astype(np.uint32 if counts.max() < 1 << 32 else np.uint64)
    row = (key[0].as_py(), key[1].as_py(), 0, int(counts.sum()), len(keys), pack_keys(keys), pack(wide))
    return _table([row], _COUNT_TYPES)


def _grown(row_keys: bytes, row_counts: bytes, n: int) -> tuple[list[tree.Level], list[tuple]]:
    return tree.grow(unpack_keys(row_keys, n), _counts(row_counts, n).astype(np.int64), tree.DEPTH, tree.SPLIT)


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n, keys, counts in zip(*(batch.column(x).to_pylist() for x in ("n", "keys", "counts")), strict=True):
            _, above = _grown(keys, counts, n)
            for bit, (nodes, zeros, ones, logs) in enumerate(above):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(nodes), bit), pa.int32()), pa.array(nodes.astype(np.int64)), pa.array(zeros), pa.array(ones), pa.array(logs)],
                    names=["bit", "node", "zeros", "ones", "logs"],
                )


def train(docs: DataFrame, training: Column) -> DataFrame:
    """The model as a table in the shared folder: a row for each kind and bucket, with keys and counts."""
    size = total_bytes(docs)
    n_buckets = 1 + size // BATCH_BYTES
    rows = docs.where(training).select(F.coalesce("text", F.lit("")).alias("text"), F.lit(1).cast("long").alias("weight"))
    found = rows.mapInArrow(_trained(n_buckets, BATCH_BYTES), _COUNT_ROWS)
    # batches are numbered task by task here; shards only bound what one merge takes in
    sharded = found.withColumn("shard", F.pmod(F.xxhash64("keys"), F.lit(1 + size // (SHARD * BATCH_BYTES))))
    merged = sharded.groupBy("kind", "bucket", "shard").applyInArrow(_merged, _COUNT_ROWS)
    return write_out(merged.groupBy("kind", "bucket").applyInArrow(_merged, _COUNT_ROWS), "model")


def _asked(n_buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, tokens = _lists(table)[:2]
        rows = [*_bucket_rows(_BYTES, keys, None, n_buckets, key[0].as_py())]
        rows.extend(_bucket_rows(_WORDS, tokens, None, n_buckets, key[0].as_py()))
        return _table(rows, _COUNT_TYPES)

    return run


def _lists(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Distinct keys and tokens of a batch, in order."""
    table = merged_copies(table)
    keys, tokens = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for batch in table.to_batches():
        for piece in pieces(batch, "text"):
            keys.append(np.unique(_sequences([x.as_py().encode() for x in piece.column("text")])[0]))
            tokens.append(np.unique(_tokens(piece)[0]))
    return np.unique(np.concatenate(keys)), np.unique(np.concatenate(tokens)), table


_ANSWER = "batch long, kind int, bucket long, n long, answer binary"
_ANSWER_TYPES = {"batch": pa.int64(), "kind": pa.int32(), "bucket": pa.int64(), "n": pa.int64(), "answer": pa.binary()}


def _answered(tops: list[tree.Level]):
    def run(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
        kind = key[0].as_py()
        lists = [unpack_keys(keys, n) for n, keys in zip(asked["n"].to_pylist(), asked["keys"].to_pylist(), strict=True)]
        if not lists:
            return _table([], _ANSWER_TYPES)
        every = np.unique(np.concatenate(lists))
        if kind == _BYTES:
            levels = _grown(model["keys"][0].as_py(), model["counts"][0].as_py(), model["n"][0].as_py())[0] if len(model) else [tree.Level()] * 0
            if not levels:
                levels = [_no_level() for _ in range(tree.DEPTH - tree.SPLIT + 1)]
            values = np.concatenate(
                [tree.log10_probability(part, levels + tops) for part in np.array_split(every, len(every) // (1 << 18) + 1)]
            ).astype(np.float32)
        else:
            values = np.zeros(len(every), dtype=np.int64)
            if len(model):
                known = unpack_keys(model["keys"][0].as_py(), model["n"][0].as_py())
                at = np.minimum(np.searchsorted(known, every), len(known) - 1)
                counts = _counts(model["counts"][0].as_py(), len(known)).astype(np.int64)
                values = np.where(known[at] == every, counts[at], 0)
        rows = [
            (batch, kind, key[1].as_py(), len(part), pack(values[np.searchsorted(every, part)]))
            for batch, part in zip(asked["batch"].to_pylist(), lists, strict=True)
        ]
        return _table(rows, _ANSWER_TYPES)

    return run


def _no_level() -> tree.Level:
    level = tree.Level()
    level.keys = level.one = level.odds = [np.zeros(0)] * 8
    return level


_SCORES = "key binary, n_tokens long, n_known long, base_sum double, score double"
_SCORE_TYPES = {
    "key": pa.binary(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_sum": pa.float64(), "score": pa.float64(),
}


def _scored(n_buckets: int):
    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return _table([], _SCORE_TYPES)
        keys, tokens, table = _lists(table)
        logs = _in_order(_BYTES, keys, answers, n_buckets, np.float32).astype(np.float64)
        counts = _in_order(_WORDS, tokens, answers, n_buckets, np.int64)
        rows = []
        for batch in table.to_batches():
            for piece in pieces(batch, "text"):
                n = len(piece)
                found, sizes = _sequences([x.as_py().encode() for x in piece.column("text")])
                score = np.bincount(np.repeat(np.arange(n), sizes), logs[np.searchsorted(keys, found)], n)
                said, owner = _tokens(piece)
                count = counts[np.searchsorted(tokens, said)]
                rows.append(
                    (
                        piece.column("key").to_pylist(), np.bincount(owner, minlength=n), np.bincount(owner, count > 0, n).astype(np.int64),
                        np.bincount(owner, np.log10(count + 1.0), n), score,
                    )
                )
        return pa.concat_tables(
            [pa.table({name: pa.array(x, kind) for (name, kind), x in zip(_SCORE_TYPES.items(), row, strict=True)}) for row in rows]
        )

    return run


def _in_order(kind: int, keys: np.ndarray, answers: pa.Table, n_buckets: int, dtype: type) -> np.ndarray:
    """Answers for sorted keys, from one row for each bucket."""
    found = {
        bucket: unpack(data, n, dtype)
        for of, bucket, n, data in zip(*(answers[x].to_pylist() for x in ("kind", "bucket", "n", "answer")), strict=True)
        if of == kind
    }
    buckets = _bucket_of(kind, keys, n_buckets)
    order = np.argsort(buckets, kind="stable")
    out = np.empty(len(keys), dtype=dtype)
    out[order] = np.concatenate([found[bucket] for bucket in np.unique(buckets)])
    return out


def held_out(fold: int = 2, folds: int = 7) -> Column:
    """crc32 of doc_id as text, mod folds, is fold; a null doc_id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    Learns from all documents that are not held out, each row once for each time it is there. Scores are log10
    probabilities of the words and the end; `bits_per_byte` is the score as a code length per byte scored. A null or empty
    text is the end alone. A null doc_id stays null, is not held out, and its text is learnt from. One row for each row in;
    equal texts have equal scores. Without training documents every bit has the probability one half and train_tokens is
    0. Other columns are left out. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(docs, ~held_out())
    bytes_model, words_model = (model.where(F.col("kind") == kind) for kind in (_BYTES, _WORDS))
    above = bytes_model.select("n", "keys", "counts").mapInArrow(_tops, "bit int, node long, zeros double, ones double, logs double")
    above = above.groupBy("bit", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("logs"))
    tops = tree.top_levels([tuple(row) for row in above.collect()], tree.SPLIT - 1)
    total = words_model.agg(F.sum("batch").alias("tokens"), F.sum("n").alias("distinct")).first()
    n_train, n_distinct = total.tokens or 0, total.distinct or 0

    size = total_bytes(docs)
    n_buckets = 1 + size // BATCH_BYTES
    dealt = dealt_texts(docs, F.col("doc_id"), F.lit(1), 1 + size // BATCH_BYTES)
    groups = dealt.groupBy("batch")
    asked = groups.applyInArrow(_asked(n_buckets), _COUNT_ROWS)
    last_shard = size // (BATCH_BYTES * SHARD)
    shown = model.select("kind", "bucket", "n", "keys", "counts", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last_shard).cast("long"))).alias("shard"))
    answers = (
        asked.groupBy("kind", "bucket", "shard")
        .cogroup(shown.groupBy("kind", "bucket", "shard"))
        .applyInArrow(_answered(tops), _ANSWER)
    )
    found = groups.cogroup(answers.groupBy("batch")).applyInArrow(_scored(n_buckets), _SCORES)
    by_row = docs.select("doc_id", held_out().alias("held_out"), text_key().alias("key"), F.octet_length(F.coalesce("text", F.lit(""))).alias("n_bytes"))
    return by_row.join(found, "key").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_sum") - F.col("n_tokens") * float(np.log10(n_train + n_distinct + 1))).alias("base_score"),
        "score",
        (-F.col("score") * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
