"""Benchmark decontamination by q-gram lemma filtering.

Benchmark texts are cut into overlapping windows. If a window of m characters occurs in a text with at most k edits, the
two share at least m + 1 - (k + 1) * q of their q-grams, on diagonals no more than k apart. So shared q-grams are counted
in overlapping bands of 2 * (k + 1) diagonals, which hold every such run of diagonals whole. Windows that reach the bound
in a band are held against the bound for shorter q-grams there, which is closer, and what is left is verified by an
alignment limited to the band and k diagonals around it. The filters lose no occurrence.

A window begins every STRIDE characters, so a passage of WINDOW + STRIDE - 1 characters holds a whole window wherever in
its benchmark text it begins. Windows that begin within SPAN characters travel as one segment, whose q-grams are counted
once for all of them.

Texts are compared as letters and digits in lower case; any run of other characters is one space.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listora.llm.arrow_batches import binary_rows, pieces
from listora.llm.hashing import mixed, windows
from listora.session import write_out

WINDOW = 80  # characters
STRIDE = 1
SPAN = 64  # characters, a multiple of STRIDE: windows that begin in them are a segment, and bits of one long
SEGMENT = SPAN + WINDOW - 1  # characters at most
GRAM = 8
CLOSE_GRAM = 4
EDITS = 0.1  # of a window's characters
SHORTEST = 24  # characters; shorter benchmark texts have to occur as they are, as whole words
BLOCK = 16_384  # as many windows' characters are sent to the executors at once, under 6 MB
PART = 2_048  # segments that are counted at once

_CHUNK = 1 << 20
_FILTER_BITS = 22


@functools.cache
def _kept() -> np.ndarray:
    """Lower-case code point of each letter or digit, 0 for anything else."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalnum():
            table[code] = ord(char.lower()[0])
    return table


def normal(text: str) -> np.ndarray:
    """Code points of a text as it is compared; no space at either end."""
    table = _kept()
    parts = [np.zeros(0, dtype=np.uint32)]
    for low in range(0, len(text), _CHUNK):
        codes = np.frombuffer(text[low : low + _CHUNK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        parts.append(table[codes])
    found = np.concatenate(parts)
    keep = found != 0
    found = np.where(keep, found, np.uint32(32))
    keep[1:] |= found[:-1] != 32
    found = found[keep]
    return found[:-1] if len(found) and found[-1] == 32 else found


def budget(length: int, share: float = EDITS, gram: int = GRAM) -> int:
    """Edits allowed in a window: the share, but no more than leaves the q-gram bound above 0; none below SHORTEST."""
    return 0 if length < SHORTEST else max(0, min(int(length * share), (length + 1 - gram - 1) // gram))


def cut_windows(symbols: np.ndarray) -> list[int]:
    """Where windows begin; the last one ends with the text, and a short text is one window."""
    if not len(symbols):
        return []
    last = max(0, len(symbols) - WINDOW)
    return sorted({*range(0, last, STRIDE), last})


def cut_segments(symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Where each segment begins and its characters; its own windows are the text's windows that begin in it."""
    last = max(0, len(symbols) - WINDOW)
    for at in range(0, last + 1 if len(symbols) else 0, SPAN):
        yield at, symbols[at : len(symbols) if at + SPAN > last else at + SPAN - STRIDE + WINDOW]


def _bits(places: np.ndarray) -> np.ndarray:
    return (np.uint64(1) << places.astype(np.uint64)).view(np.int64)


def _next(hashes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Hashes of texts that are one symbol longer."""
    return mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + symbols + np.uint64(1))


@dataclass(frozen=True)
class _Index:
    """q-grams of some segments: sorted distinct hashes, and which (segment, place) each stands for.

    Segments below SHORTEST have no q-grams here but a hash of their whole text, by length: `short`.
    """

    symbols: np.ndarray
    keys: np.ndarray
    lengths: np.ndarray
    edits: np.ndarray
    bounds: np.ndarray
    n_windows: np.ndarray
    window_at: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    segment: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: list[tuple[int, bytes]]) -> _Index:
        symbols = [np.frombuffer(data, dtype=np.uint32) for _, data in rows]
        table = np.zeros((len(rows), SEGMENT), dtype=np.uint32)
        for row, x in zip(table, symbols, strict=True):
            row[: len(x)] = x
        sizes = np.array([len(x) for x in symbols])
        lengths = np.minimum(sizes, WINDOW)
        edits = np.array([budget(n) for n in lengths])
        cut = [cut_windows(x) for x in symbols]
        n_windows = np.array([len(x) for x in cut])
        window_at = np.zeros((len(rows), n_windows.max()), dtype=np.int64)
        for row, x in zip(window_at, cut, strict=True):
            row[: len(x)] = x
        hashes = [windows(mixed(x), GRAM) if len(x) >= SHORTEST else np.zeros(0, dtype=np.uint64) for x in symbols]
        flat = np.concatenate(hashes)
        segment = np.repeat(np.arange(len(rows)), [len(x) for x in hashes])
        place = np.concatenate([np.arange(len(x)) for x in hashes])
        order = np.argsort(flat, kind="stable")
        grams, first = np.unique(flat[order], return_index=True)
        seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
        seen[grams >> np.uint64(64 - _FILTER_BITS)] = True
        short = {}
        for length in np.unique(sizes[sizes < SHORTEST]):
            of = np.flatnonzero(sizes == length)
            whole = np.zeros(len(of), dtype=np.uint64)
            for i in range(length):
                whole = _next(whole, table[of, i])
            by = np.argsort(whole)
            short[int(length)] = whole[by], of[by]
        return _Index(
            table, np.array([key for key, _ in rows], dtype=np.int64), lengths, edits, lengths + 1 - (edits + 1) * GRAM,
            n_windows, window_at, grams, np.append(first, len(flat)), segment[order], place[order], seen, short,
        )

    def find(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of the text, number of the segment, which of its windows (bits) a text has, and the least edits."""
        first = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(x) for x in texts], out=first[1:])
        flat = np.concatenate(texts) if texts else np.zeros(0, dtype=np.uint32)
        at, gram = self._hits(flat)
        owner = np.searchsorted(first, at, side="right") - 1
        inside = at + GRAM <= first[owner + 1]
        at, gram, owner = at[inside], gram[inside], owner[inside]
        found = self._align(flat, first, *self._close(flat, first, *self._full_windows(at - first[owner], owner, gram, first)))
        return tuple(np.concatenate(x) for x in zip(found, self._whole(flat, first), strict=True))

    def _hits(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        for low in range(0, len(flat) if len(self.grams) else 0, _CHUNK):
            hashes = windows(mixed(flat[low : low + _CHUNK + GRAM - 1]), GRAM)
            maybe = np.flatnonzero(self.seen[hashes >> np.uint64(64 - _FILTER_BITS)])
            gram = np.minimum(np.searchsorted(self.grams, hashes[maybe]), len(self.grams) - 1)
            same = self.grams[gram] == hashes[maybe]
            found.append((maybe[same] + low, gram[same]))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def _full_windows(self, at, owner, gram, first) -> tuple[np.ndarray, ...]:
        """Text, segment and lowest diagonal of bands, and the band and the place of windows with enough q-grams in it."""
        repeats = np.diff(self.first)[gram]
        begin = np.repeat(self.first[gram] - (np.cumsum(repeats) - repeats), repeats)
        entry = begin + np.arange(int(repeats.sum()))
        segment, place = self.segment[entry], self.place[entry]
        steps = int(self.edits.max()) + 1
        upper = (np.repeat(at, repeats) - place + SEGMENT) // steps
        n_bands = int(np.diff(first).max(initial=0) + 2 * SEGMENT) // steps + 2
        base = (np.repeat(owner, repeats) * len(self.keys) + segment) * n_bands
        keys = np.concatenate((base + upper, (base + upper - 1)[upper > 0]))
        places = np.concatenate((place, place[upper > 0]))
        order = np.argsort(keys, kind="stable")
        bands, begin, counts = np.unique(keys[order], return_index=True, return_counts=True)
        enough = np.flatnonzero(counts >= self.bounds[bands // n_bands % len(self.keys)])
        bands, begin, counts = bands[enough], begin[enough], counts[enough]
        number = np.repeat(np.arange(len(bands)), counts)
        inside = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        shared = np.sort(number * SEGMENT + places[order][inside])
        pair, band = np.divmod(bands, n_bands)
        text, segment = np.divmod(pair, len(self.keys))
        of = np.repeat(np.arange(len(bands)), self.n_windows[segment])
        nth = np.arange(len(of)) - np.repeat(np.cumsum(self.n_windows[segment]) - self.n_windows[segment], self.n_windows[segment])
        window = self.window_at[segment[of], nth]
        low = of * SEGMENT + window
        n_shared = np.searchsorted(shared, low + self.lengths[segment[of]] - GRAM + 1) - np.searchsorted(shared, low)
        full = n_shared >= self.bounds[segment[of]]
        return text, segment, band * steps - SEGMENT, of[full], window[full]

    def _close(self, flat, first, text, segment, low, of, window) -> tuple[np.ndarray, ...]:
        """Text, segment, place, lowest diagonal and whether it is there unedited, of windows with enough short q-grams."""
        width = 2 * (int(self.edits.max()) + 1)
        out = [tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0, dtype=bool),)]
        bands, edge = np.unique(of, return_index=True)
        edge = np.append(edge, len(of))
        for begin in range(0, len(bands), 512):
            some = bands[begin : begin + 512]
            rows = slice(edge[begin], edge[begin + len(some)])
            at, nth = window[rows], np.searchsorted(some, of[rows])
            column = low[some, None] + np.arange(SEGMENT + width - 1)
            valid = (column >= 0) & (column < (first[text[some] + 1] - first[text[some]])[:, None])
            near = np.where(valid, flat[np.where(valid, first[text[some], None] + column, 0)], np.uint32(1))
            same = np.lib.stride_tricks.sliding_window_view(near, width, axis=1) == self.symbols[segment[some], :, None]
            shared = same[:, : 1 - CLOSE_GRAM].copy()
            for i in range(1, CLOSE_GRAM):
                shared &= same[:, i : SEGMENT + 1 - CLOSE_GRAM + i]
            sums = np.zeros((len(some), SEGMENT + 2 - CLOSE_GRAM), dtype=np.int64)
            np.cumsum(shared.any(axis=2), axis=1, out=sums[:, 1:])
            size, edits = self.lengths[segment[some[nth]]], self.edits[segment[some[nth]]]
            n_shared = sums[nth, at + size + 1 - CLOSE_GRAM] - sums[nth, at]
            keep = n_shared >= size + 1 - (edits + 1) * CLOSE_GRAM
            at, nth, size = at[keep], nth[keep], size[keep]
            left, nth_left = np.unique(nth, return_inverse=True)
            runs = np.zeros((len(left), SEGMENT + 1, width), dtype=np.int16)
            np.cumsum(same[left], axis=1, out=runs[:, 1:])
            exact = (runs[nth_left, at + size] - runs[nth_left, at] == size[:, None]).any(axis=1)
            out.append((text[some[nth]], segment[some[nth]], at, low[some[nth]], exact))
        text, segment, window, low, exact = (np.concatenate(x) for x in zip(*out, strict=True))
        keys = (text * len(self.keys) + segment) * SEGMENT + window
        left = exact | ~np.isin(keys, keys[exact])  # nothing beats an unedited window
        return text[left], segment[left], window[left], low[left], exact[left]

    def _align(self, flat, first, text, segment, window, low, exact) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows whose edit distance to the best stretch of their text within the band is in their budget."""
        steps, most = int(self.edits.max()) + 1, int(self.edits.max())
        lowest = low - most + window
        width = 2 * steps + 2 * most
        across = np.arange(width, dtype=np.int32)
        edits = np.zeros(len(text), dtype=np.int64)
        for length in np.unique(self.lengths[segment]):
            for rows in np.array_split(of := np.flatnonzero((self.lengths[segment] == length) & ~exact), len(of) // 4096 + 1):
                row = np.zeros((len(rows), width), dtype=np.int32)
                begin, size = first[text[rows], None], (first[text[rows] + 1] - first[text[rows]])[:, None]
                for i in range(length):
                    column = lowest[rows, None] + i + across
                    valid = (column >= 0) & (column < size)
                    symbol = flat[np.where(valid, begin + column, 0)]
                    best = row + ((symbol != self.symbols[segment[rows], window[rows] + i, None]) | ~valid)
                    best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
                    row = np.minimum.accumulate(best - across, axis=1) + across
                edits[rows] = row.min(axis=1)
        good = edits <= self.edits[segment]
        text, segment, window, edits = text[good], segment[good], window[good], edits[good]
        order = np.lexsort((segment, text))
        text, segment, window, edits = text[order], segment[order], window[order], edits[order]
        other = np.ones(len(text), dtype=bool)
        other[1:] = (text[1:] != text[:-1]) | (segment[1:] != segment[:-1])
        begin = np.flatnonzero(other)
        if not len(begin):
            return text, segment, window, edits
        bits = np.bitwise_or.reduceat(_bits(window), begin)
        return text[begin], segment[begin], bits, np.minimum.reduceat(edits, begin)

    def _whole(self, flat, first) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Segments below SHORTEST that occur as they are, from the start of a word to the end of one."""
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        if self.short and len(flat):
            begins = flat != 32
            begins[1:] &= flat[:-1] == 32
            begins[first[:-1][np.diff(first) > 0]] = True
            at = np.flatnonzero(begins)
            owner = np.searchsorted(first, at, side="right") - 1
            hashes = np.zeros(len(at), dtype=np.uint64)
            for i in range(max(self.short)):
                inside = at + i < first[owner + 1]
                at, owner, hashes = at[inside], owner[inside], hashes[inside]
                hashes = _next(hashes, flat[at + i])
                if i + 1 not in self.short:
                    continue
                ends = (at + i + 1 == first[owner + 1]) | (flat[np.minimum(at + i + 1, len(flat) - 1)] == 32)
                whole, segment = self.short[i + 1]
                nth = np.minimum(np.searchsorted(whole, hashes), len(whole) - 1)
                same = ends & (whole[nth] == hashes)
                found.append((owner[same], segment[nth[same]]))
        text, segment = (np.concatenate(x) for x in zip(*found, strict=True))
        pairs = np.unique(text * len(self.keys) + segment)
        text, segment = np.divmod(pairs, len(self.keys))
        return text, segment, np.ones(len(text), dtype=np.int64), np.zeros(len(text), dtype=np.int64)


def _segments_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            ids, places, bits, parts = [], [], [], []
            for item, text in zip(piece.column("item_id"), piece.column("text"), strict=True):
                for at, symbols in cut_segments(normal(text.as_py() or "")):
                    ids.append(item.as_py())
                    places.append(at)
                    bits.append(int(np.bitwise_or.reduce(_bits(np.array(cut_windows(symbols))))))
                    parts.append(symbols)
            first = np.zeros(len(parts) + 1, dtype=np.int64)
            np.cumsum([len(x) for x in parts], out=first[1:])
            flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(places, pa.int64()), pa.array(bits, pa.int64()), binary_rows(flat, first)],
                names=["item_id", "place", "windows", "symbols"],
            )


def benchmark_segments(benchmark: DataFrame) -> DataFrame:
    """item_id, place, windows, key, symbols of every segment of the benchmark; equal segments share their key."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        _segments_of, "item_id long, place long, windows long, symbols binary"
    )
    return write_out(rows.withColumn("key", F.xxhash64("symbols")), "benchmark")


def _blocks(spark: SparkSession, found: DataFrame) -> Iterator[object]:
    """Distinct segments in blocks of about the bytes of BLOCK windows, each sent to the executors."""
    distinct = found.groupBy("key").agg(F.min("symbols").alias("symbols"))
    size = distinct.agg(F.sum(F.octet_length("symbols"))).first()[0] or 0
    n_blocks = math.ceil(size / (BLOCK * WINDOW * 4))
    for block in range(n_blocks):
        rows = distinct.where(F.pmod("key", F.lit(n_blocks)) == block).collect()
        yield spark.sparkContext.broadcast([(row.key, bytes(row.symbols)) for row in rows])


def _found_in(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_Index.of(block.value[low : low + PART]) for low in range(0, len(block.value), PART)]
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = [normal(text.as_py() or "") for text in piece.column("text")]
                for index in parts:
                    text, segment, bits, edits = index.find(texts)
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("doc_id").take(pa.array(text)), pa.array(index.keys[segment]), pa.array(bits), pa.array(edits)],
                        names=["doc_id", "key", "windows", "edits"],
                    )

    return run


def _free_of(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_Index.of(block.value[low : low + PART]) for low in range(0, len(block.value), PART)]
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = [normal(text.as_py() or "") for text in piece.column("text")]
                clean = np.ones(len(texts), dtype=bool)
                for index in parts:
                    clean[index.find(texts)[0]] = False
                yield piece.filter(pa.array(clean))

    return run


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows, edits, share of every benchmark text that a document has a passage of.

    n_windows is how many of the item's windows occur in the document, edits the least number of edits of any, share the
    part of the item's windows found. Windows have 80 compared characters, begin at every character and may differ by 8
    edits: any passage of 80 characters with up to 8 edits is found, wherever in its item it begins. Items with 24 to 79
    are one window with a budget of a tenth that the q-gram bound allows; shorter ones have to occur unedited, as whole
    words. Empty and null items match nothing, as do null and empty documents. Repeated rows and rows that share an id
    count once together; null ids stay null. Other columns are left out. An empty table on either side gives no rows.

    The benchmark is sent to the executors in blocks of at most about 6 MB whatever its size, each
    held against all documents in a pass of its own; documents are not shuffled.
    """
    spark = docs.sparkSession
    found = benchmark_segments(benchmark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kinds = "doc_id long, key long, windows long, edits long"
    hits = spark.createDataFrame([], kinds)
    for block in _blocks(spark, found):
        hits = hits.union(texts.mapInArrow(_found_in(block), kinds))
    both = F.bit_or("windows").alias("windows")
    hits = hits.groupBy("doc_id", "key").agg(both, F.min("edits").alias("edits"))
    sizes = found.groupBy(F.col("item_id").alias("sized"), "place").agg(both)
    sizes = sizes.groupBy("sized").agg(F.sum(F.bit_count("windows")).alias("of"))
    return (
        hits.join(found.select("item_id", "place", "key"), "key")
        .groupBy("doc_id", "item_id", "place").agg(both, F.min("edits").alias("edits"))
        .groupBy("doc_id", "item_id").agg(F.sum(F.bit_count("windows")).alias("n_windows"), F.min("edits").alias("edits"))
        .join(sizes, F.col("item_id").eqNullSafe(F.col("sized")))
        .select("doc_id", "item_id", "n_windows", "edits", (F.col("n_windows") / F.col("of")).alias("share"))
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of `docs`, all columns as they are, without a passage of the benchmark (see `leaks`)."""
    schema = docs.schema
    for block in _blocks(docs.sparkSession, benchmark_segments(benchmark)):
        docs = docs.mapInArrow(_free_of(block), schema)
    return docs
