"""Substring dedup with difference-cover anchors.

A window is 13 consecutive words. Anchors are 7-word windows at the word positions that are 0, 1 or 3 modulo 7. These
residues are a difference cover: any two positions i and j have a shift below 7 that brings both onto the cover, so any
13 words that two documents share hold a 7-word anchor that both have hashed. Only windows around an anchor that occurs
more than once are looked at further: they extend to their 13 words, and each is compared with the least doc_id that has
the same words.

Documents are dealt into batches of bounded size. Per batch, equal hashes collapse before they are shuffled, in one row
for each bucket of the hash range, so a passage that a third of all documents share takes one entry from each batch; what
comes back is a bit for each anchor and an id for each window. Copies of a whole text collapse before that.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listora.llm.arrow_batches import pieces
from listora.llm.distinct_texts import dealt_texts, fresh_names, merged_copies, text_key, total_bytes
from listora.llm.hashing import whole_windows, windows, words
from listora.llm.key_counts import pack, pack_keys, unpack, unpack_keys

WINDOW = 13  # words
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1  # words
BATCH_BYTES = 8 << 20  # of text
BUCKET_HASHES = 1 << 19

_ANCHORS, _LEAST = 0, 1
_ROWS = "batch long, bucket long, kind int, n long, a binary, b binary, c binary"
_RESULT = "key binary, doc_id long, n_words long, n_removed long, kept_sha256 string, all_sha256 string, spans array<struct<first:int,end:int>>"
_RESULT_TYPES = {
    "key": pa.binary(), "doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "all_sha256": pa.string(),
    "spans": pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])),
}


class _Batch:
    """Anchors and windows of the documents of a batch; hashes are sorted, so row order does not matter."""

    def __init__(self, table: pa.Table):
        self.keys, self.texts, self.named = [], [], []
        ids, anchors, anchor_at, hashes, first, total = [], [], [], [], [0], 0
        for batch in merged_copies(table).to_batches():
            for piece in pieces(batch, "text"):
                found = words(piece.column("text"))
                named = piece.column("least").is_valid().to_numpy(zero_copy_only=False)
                at = whole_windows(found, ANCHOR)
                owner = np.searchsorted(found.first, at, side="right") - 1
                on_cover = np.isin((at - found.first[owner]) % PERIOD, COVER) & named[owner]
                anchors.append(windows(found.hashes, ANCHOR)[at[on_cover]])
                anchor_at.append(at[on_cover] + total)
                hashes.append(found.hashes)
                first.extend((found.first[1:] + total).tolist())
                total += len(found.hashes)
                ids.append(piece.column("least").fill_null(-1).to_numpy())
                self.named.extend(named.tolist())
                self.keys.extend(piece.column("key").to_pylist())
                self.texts.append(piece.column("text"))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
        self.ids, self.first = join(ids, np.int64), np.array(first)
        self.hashes, self.anchor_at = join(hashes, np.uint64), join(anchor_at, np.int64)
        self.anchors, self.place, self.often = np.unique(join(anchors, np.uint64), return_inverse=True, return_counts=True)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """First words of the windows around shared anchors."""
        near = self.anchor_at[shared[self.place]]
        owner = np.searchsorted(self.first, near, side="right") - 1
        low = np.maximum(near - (WINDOW - ANCHOR), self.first[owner])
        high = np.minimum(near, self.first[owner + 1] - WINDOW)
        valid = high >= low
        steps = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        np.add.at(steps, low[valid], 1)
        np.add.at(steps, high[valid] + 1, -1)
        return np.flatnonzero(np.cumsum(steps)[:-1] > 0)

    def windows_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct windows (two hashes), the least doc_id of each here, and for `at`: which one, and its doc_id."""
        if not len(at):
            none = np.zeros(0, dtype=np.uint64)
            return none, none, np.zeros(0, dtype=np.int64), at, at
        one, two = windows(self.hashes, WINDOW)[at], windows(self.hashes, WINDOW, seed=1)[at]
        ids = self.ids[np.searchsorted(self.first, at, side="right") - 1]
        order = np.lexsort((ids, two, one))
        new = np.ones(len(at), dtype=bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        which = np.empty(len(at), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        picked = order[new]
        return one[picked], two[picked], ids[picked], which, ids


def _bucket_edges(hashes: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that sorted hashes fall into, and where each begins (and the end)."""
    buckets = (hashes >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)
    found, first = np.unique(buckets, return_index=True)
    return found.astype(np.int64), np.append(first, len(hashes))


def _table(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.table({name: pa.array(column, kind) for (name, kind), column in zip(kinds.items(), columns, strict=True)})


_ROW_TYPES = {"batch": pa.int64(), "bucket": pa.int64(), "kind": pa.int32(), "n": pa.int64(), "a": pa.binary(), "b": pa.binary(), "c": pa.binary()}


def _anchor_rows(n_buckets: int, key: tuple, table: pa.Table) -> pa.Table:
    batch = _Batch(table)
    buckets, edges = _bucket_edges(batch.anchors, n_buckets)
    rows = []
    for bucket, low, high in zip(buckets, edges, edges[1:], strict=False):
        often = np.packbits(batch.often[low:high] > 1).tobytes()
        rows.append((key[0].as_py(), bucket, _ANCHORS, high - low, pack_keys(batch.anchors[low:high]), often, None))
    return _table(rows, _ROW_TYPES)


def _shared_anchors(table: pa.Table) -> pa.Table:
    """For each row, a bit for each of its anchors: does it occur more than once?"""
    parts = [unpack_keys(data, n) for n, data in zip(table["n"].to_pylist(), table["a"].to_pylist(), strict=True)]
    often = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=len(y)) for x, y in zip(table["b"], parts, strict=True)]
    _, place, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = (counts[place] > 1) | (np.concatenate(often) > 0)
    rows, low = [], 0
    for batch, bucket, part in zip(table["batch"].to_pylist(), table["bucket"].to_pylist(), parts, strict=True):
        bits = np.packbits(shared[low : low + len(part)]).tobytes()
        rows.append((batch, bucket, _ANCHORS, len(part), bits, None, None))
        low += len(part)
    return _table(rows, _ROW_TYPES)


def _returned(back: pa.Table, kind: int) -> dict[int, tuple[bytes, int]]:
    rows = zip(*(back[name].to_pylist() for name in ("bucket", "kind", "a", "n")), strict=True)
    return {bucket: (data, n) for bucket, of, data, n in rows if of == kind}


def _candidates(batch: _Batch, back: pa.Table, n_buckets: int) -> np.ndarray:
    shared = np.zeros(len(batch.anchors), dtype=bool)
    bits = _returned(back, _ANCHORS)
    buckets, edges = _bucket_edges(batch.anchors, n_buckets)
    for bucket, low, high in zip(buckets, edges, edges[1:], strict=False):
        shared[low:high] = np.unpackbits(np.frombuffer(bits[bucket][0], dtype=np.uint8), count=high - low)
    return batch.candidates(shared)


def _window_rows(n_buckets: int, key: tuple, docs: pa.Table, back: pa.Table) -> pa.Table:
    if not docs.num_rows:
        return _table([], _ROW_TYPES)
    batch = _Batch(docs)
    one, two, least, _, _ = batch.windows_at(_candidates(batch, back, n_buckets))
    buckets, edges = _bucket_edges(one, n_buckets)
    return _table(
        [
            (key[0].as_py(), bucket, _LEAST, high - low, pack_keys(one[low:high]), two[low:high].tobytes(), pack(least[low:high]))
            for bucket, low, high in zip(buckets, edges, edges[1:], strict=False)
        ],
        _ROW_TYPES,
    )


def _least_ids(table: pa.Table) -> pa.Table:
    """For each row, the least doc_id anywhere of each of its windows."""
    sizes = table["n"].to_pylist()
    one = [unpack_keys(data, n) for n, data in zip(sizes, table["a"].to_pylist(), strict=True)]
    two = [np.frombuffer(data, dtype=np.uint64) for data in table["b"].to_pylist()]
    ids = np.concatenate([unpack(data, n, np.int64) for n, data in zip(sizes, table["c"].to_pylist(), strict=True)])
    flat_one, flat_two = np.concatenate(one), np.concatenate(two)
    order = np.lexsort((ids, flat_two, flat_one))
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (flat_one[order][1:] != flat_one[order][:-1]) | (flat_two[order][1:] != flat_two[order][:-1])
    least = np.empty(len(ids), dtype=np.int64)
    least[order] = ids[order][new][np.cumsum(new) - 1]
    rows, low = [], 0
    for batch, bucket, part in zip(table["batch"].to_pylist(), table["bucket"].to_pylist(), one, strict=True):
        rows.append((batch, bucket, _LEAST, len(part), pack(least[low : low + len(part)]), None, None))
        low += len(part)
    return _table(rows, _ROW_TYPES)


def _removed(n_buckets: int, key: tuple, docs: pa.Table, back: pa.Table) -> pa.Table:
    if not docs.num_rows:
        return _table([], _RESULT_TYPES)
    batch = _Batch(docs)
    at = _candidates(batch, back, n_buckets)
    one, _, _, which, ids = batch.windows_at(at)
    found = _returned(back, _LEAST)
    buckets, _ = _bucket_edges(one, n_buckets)
    least = np.concatenate([np.zeros(0, np.int64), *(unpack(*found[bucket], np.int64) for bucket in buckets)])
    gone_at = at[least[which] < ids] if len(at) else at
    steps = np.zeros(len(batch.hashes) + 1, dtype=np.int64)
    np.add.at(steps, gone_at, 1)
    np.add.at(steps, gone_at + WINDOW, -1)
    gone = np.cumsum(steps)[:-1] > 0
    rows = []
    for i, text in enumerate(itertools.chain.from_iterable(batch.texts)):
        mask = gone[batch.first[i] : batch.first[i + 1]]
        found_words = (text.as_py() or "").encode().split()
        every = hashlib.sha256(b" ".join(found_words)).hexdigest()
        count = int(mask.sum())
        kept = hashlib.sha256(b" ".join(itertools.compress(found_words, ~mask))).hexdigest() if count else every
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0])))).reshape(-1, 2)
        spans = [{"first": a, "end": b} for a, b in edges.tolist()]
        rows.append((batch.keys[i], int(batch.ids[i]) if batch.named[i] else None, len(found_words), count, kept, every, spans))
    return _table(rows, _RESULT_TYPES)


def repeated_spans(docs: DataFrame, batch_bytes: int = BATCH_BYTES, bucket_hashes: int = BUCKET_HASHES) -> DataFrame:
    """What to remove from the copy with the least doc_id of each distinct text: key (its md5), doc_id, n_words,
    n_removed, kept_sha256, all_sha256 and spans (word ranges, first and end), for rows doc_id, text."""
    size = total_bytes(docs)
    n_batches = 1 + size // batch_bytes
    n_buckets = 1 + size // (5 * bucket_hashes)  # a word takes about 6 bytes and gives 3 / 7 of an anchor
    dealt = dealt_texts(docs, F.col("doc_id"), F.lit(1), n_batches)
    groups = dealt.groupBy("batch")
    bits = (
        groups.applyInArrow(lambda key, table: _anchor_rows(n_buckets, key, table), _ROWS)
        .groupBy("bucket").applyInArrow(_shared_anchors, _ROWS)
    )
    least = (
        groups.cogroup(bits.groupBy("batch"))
        .applyInArrow(lambda key, docs, back: _window_rows(n_buckets, key, docs, back), _ROWS)
        .groupBy("bucket").applyInArrow(_least_ids, _ROWS)
    )
    return groups.cogroup(bits.union(least).groupBy("batch")).applyInArrow(
        lambda key, docs, back: _removed(n_buckets, key, docs, back), _RESULT
    )


def _removal(doc_id: Column) -> tuple[Column, Column]:
    """Is a row a later copy of a whole text, and does it keep all words, by columns least and n_words of its text?"""
    later = F.coalesce(doc_id > F.col("least"), F.lit(False))
    copy = later & (F.col("n_words") >= WINDOW)
    return copy, doc_id.isNull() | later & ~copy


def repeated_words(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space) of every document, and the spans removed.

    Words are runs of bytes other than ASCII white space, as they stand. A word goes if a window of 13 words that covers
    it, in the text as given, also starts in a document with a smaller doc_id. Null and empty texts have no words, and
    texts under 13 words lose none. Rows with the same doc_id do not make each other's words go, whether repeated or
    different; a row with a null doc_id keeps its words and makes none go. One row out for each row in. Other columns are
    left out. An empty table gives no rows. `spans` are the word ranges removed, of which a later copy of a whole text
    has one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = repeated_spans(docs).withColumnRenamed("doc_id", "least")
    copy, untouched = _removal(F.col("doc_id"))
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("end")))
    return docs.select("doc_id", text_key().alias("key")).join(found, "key").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).when(untouched, 0).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).when(untouched, F.col("all_sha256")).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(copy, whole).when(untouched, F.slice("spans", 1, 0)).otherwise(F.col("spans")).alias("spans"),
    )


def _cut(column: str, spans: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column):
                texts = piece.column(column).to_pylist()
                for i, found in enumerate(piece.column(spans).to_pylist()):
                    if found:
                        kept, at, every = [], 0, texts[i].encode().split()
                        for span in found:
                            kept += every[at : span["first"]]
                            at = span["end"]
                        texts[i] = b" ".join(kept + every[at:]).decode()
                place = piece.schema.get_field_index(column)
                yield piece.set_column(place, piece.schema.field(place), pa.array(texts, piece.schema.field(place).type))

    return run


def without_repeats(docs: DataFrame) -> DataFrame:
    """Rows of `docs` less the words that `repeated_words` removes, and less the rows that lose all their words.

    A text that loses words is its kept words joined by one space, and n_chars, where there is such a column, is its new
    length. All other texts and columns stay as they are.
    """
    key, spans, of_key = fresh_names(docs, "text_key", "gone", "of_key")
    found = repeated_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
        F.col("key").alias(of_key),
        F.struct(F.col("doc_id").alias("least"), "n_words", "n_removed", "spans").alias(spans),
    )
    rows = docs.withColumn(key, text_key()).join(found, F.col(key) == F.col(of_key)).drop(key, of_key)
    told = F.col(spans)
    later = F.coalesce(F.col("doc_id").cast("long") > told["least"], F.lit(False))
    copy = later & (told["n_words"] >= WINDOW)
    own = ~later & F.col("doc_id").isNotNull()
    all_gone = copy | own & (told["n_removed"] > 0) & (told["n_removed"] == told["n_words"])
    rows = rows.where(~all_gone).withColumn(spans, F.when(own, told["spans"]))
    cut = rows.mapInArrow(_cut("text", spans), rows.schema).drop(spans)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), "n_chars"))
    return cut
