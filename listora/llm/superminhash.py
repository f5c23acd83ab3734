"""SuperMinHash signatures of word-shingle sets.

Each element walks its own random permutation of the signature's slots; its value in the j-th slot visited is j plus a
random fraction, and a slot keeps the smallest value over all elements. Ranks of one element are therefore correlated
(no slot gets two small values from it), which lowers the variance against independent minima, and an element may stop
once j exceeds the largest value kept so far: later steps can no longer win.
"""

from __future__ import annotations

import numpy as np

from listora.llm.hashing import mixed

_CELLS = 1 << 22  # elements taken at once, times slots
_STEP = 0xD1B54A32D192ED03


def signatures(elements: np.ndarray, first: np.ndarray, slots: int) -> np.ndarray:
    """One row of `slots` values for each set; set i has elements[first[i]:first[i + 1]]. Empty sets stay infinite.

    Elements are taken a block at a time, so memory follows the block, whatever the size of one set.
    """
    sets = len(first) - 1
    kept = np.full((sets, slots), np.inf)
    owners = np.repeat(np.arange(sets), np.diff(first))
    at_once = max(1, _CELLS // slots)
    for low in range(0, len(elements), at_once):
        _take_in(kept, elements[low : low + at_once], owners[low : low + at_once], slots)
    return kept


def _take_in(kept: np.ndarray, elements: np.ndarray, owners: np.ndarray, slots: int) -> None:
    base, last = owners[0], owners[-1] + 1
    flat = kept[base:last].reshape(-1)
    order = np.empty((len(elements), slots), dtype=np.uint16)
    order[:] = np.arange(slots, dtype=np.uint16)
    row, own, seeds = np.arange(len(elements)), owners - base, elements
    for step in range(slots):
        worst = flat.reshape(-1, slots).max(axis=1)
        going = worst[own] > step
        if not going.any():
            return
        if not going.all():
            row, own, seeds = row[going], own[going], seeds[going]
        draw = mixed(seeds + np.uint64((step + 1) * _STEP & 0xFFFFFFFFFFFFFFFF))
        fraction = (draw >> np.uint64(16)).astype(np.float64) * 2.0**-48
        swap = step + ((draw & np.uint64(0xFFFF)) * np.uint64(slots - step) >> np.uint64(16)).astype(np.int64)
        slot = order[row, swap]
        order[row, swap] = order[row, step]
        np.minimum.at(flat, own * slots + slot, step + fraction)


def sketches(kept: np.ndarray, kind: type = np.uint16) -> np.ndarray:
    """Each slot's value in 16 (or 8) bits, for a first look at pairs; equal values stay equal."""
    return (mixed(kept.view(np.uint64)) >> np.uint64(64 - 8 * np.dtype(kind).itemsize)).astype(kind)
