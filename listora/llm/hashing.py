"""Hashes of words and word windows over whole Arrow columns, as NumPy expressions without a loop per word.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. Words never
cross documents. Texts are read a piece at a time, so memory follows the piece and the number of words, whatever the
length of a single text or word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a value reaches every bit of the result; different values stay different."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_UP = _powers(_BASE, _PIECE + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _PIECE + 1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and where each begins and the last ends; null reads as empty."""
    texts = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or len(texts) == 0 or ends[-1] == ends[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


@dataclass
class Words:
    """Words of a column of texts: byte spans, one hash each, and the first word of each text (and the end)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(column: pa.Array, lower: bool = False) -> Words:
    """Words with a 64-bit hash; `lower` folds A-Z only."""
    data, offsets = text_bytes(column)
    size = len(data)
    starts, ends, at_start, at_end = [], [], [], []
    values, carry, after_word = _VALUES[lower], np.uint64(0), False
    borders = np.zeros(size + 1, dtype=bool)
    borders[offsets] = True
    for low in range(0, size, _PIECE):
        high = min(size, low + _PIECE)
        piece = data[low:high]
        inside = ~_SEPARATOR[piece]
        cut = borders[low:high]
        before = np.concatenate(([after_word], inside[:-1]))
        begins = np.flatnonzero(inside & (~before | cut))
        stops = np.flatnonzero(before & (~inside | cut))
        scale = np.uint64(pow(_BASE, low, 1 << 64))
        sums = np.empty(len(piece) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(values[piece] * _UP[: len(piece)], out=sums[1:])
        sums *= scale
        sums += carry
        starts.append(begins + low)
        at_start.append(sums[begins])
        ends.append(stops + low)
        at_end.append(sums[stops])
        carry, after_word = sums[-1], bool(inside[-1])
    if after_word:
        ends.append(np.array([size]))
        at_end.append(np.array([carry], dtype=np.uint64))
    begin = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, dtype=np.int64)
    if len(begin):
        hashes = np.concatenate(at_end) - np.concatenate(at_start)
        pieces, local = np.divmod(begin, _PIECE)
        whole = np.array(
            [pow(_BASE, -int(p) * _PIECE, 1 << 64) for p in range(int(pieces[-1]) + 1)], dtype=np.uint64
        )
        hashes = mixed(hashes * _DOWN[local] * whole[pieces])
    else:
        hashes = np.zeros(0, dtype=np.uint64)
    first = np.searchsorted(begin, offsets).astype(np.int64)
    return Words(data, begin, end, hashes, first)


def windows(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of every `width` consecutive values, at the position of the first."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(count, (seed * 0x2545F4914F6CDD1D + width) & _MASK, dtype=np.uint64)
    for i in range(width):
        factor = np.uint64(pow(_BASE, i + 1, 1 << 64) ^ (seed * 0x632BE59BD9B4E019 & (_MASK - 1)))
        total += hashes[i : i + count] * factor
    return mixed(total)


def whole_windows(words: Words, width: int) -> np.ndarray:
    """Positions of first words of the windows that lie in one text."""
    room = np.maximum(words.counts - width + 1, 0)
    shift = np.repeat(words.first[:-1] - (np.cumsum(room) - room), room)
    return np.arange(int(room.sum())) + shift
