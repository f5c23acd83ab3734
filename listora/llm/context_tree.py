"""Context-tree weighting over bytes, in NumPy.

A byte is eight binary decisions, highest bit first. A decision is predicted in the context of the bits of its byte so
far and of up to `depth` bytes before it. Each node (context, bits so far) has a Krichevsky-Trofimov estimate of its
zeros and ones; the weighted probability of a node mixes that estimate half and half with the product of its children,
which know one more byte of context. After training, the mixture predicts each bit from the nodes on its path, by the
posterior weights of the estimates; below the last node ever seen a bit has the probability one half.

A key holds the context with the nearest byte highest, then the byte itself lowest. Keys in order so hold whole subtrees
next to each other, and contexts of d bytes are the keys' first d bytes.
"""

from __future__ import annotations

import numpy as np

DEPTH = 5
SPLIT = 2  # contexts of this length and longer are worked out bucket by bucket


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers."""
    y, low = x.astype(np.float64), np.zeros(len(x))
    for _ in range(8):
        small = y < 8
        low -= np.log(y, where=small, out=np.zeros(len(x)))
        y = np.where(small, y + 1, y)
    return low + (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def keys_of(data: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Key of each byte after the first `depth`, which are context only."""
    count = len(data) - depth
    wide = data.astype(np.uint64)
    out = wide[depth:].copy()
    for back in range(1, depth + 1):
        out |= wide[depth - back : depth - back + count] << np.uint64(8 * (depth + 1 - back))
    return out


class Level:
    """Nodes of one context length: for each bit, sorted keys, the estimate of a one, and the weight of the estimate."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.one: list[np.ndarray] = []
        self.odds: list[np.ndarray | None] = []


def _nodes(keys: np.ndarray, counts: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node keys (context, bits so far) in order, with zeros and ones, from distinct (context, byte) in order."""
    node = keys >> np.uint64(8 - bit)
    first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    is_one = (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(np.int64)
    every, ones = np.add.reduceat(counts, first), np.add.reduceat(counts * is_one, first)
    return node[first], (every - ones).astype(np.float64), ones.astype(np.float64)


def _shorter(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, byte) with the farthest byte of context left out, and summed counts."""
    cut = keys >> np.uint64(16) << np.uint64(8) | keys & np.uint64(255)
    order = np.argsort(cut, kind="stable")
    cut, counts = cut[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], cut[1:] != cut[:-1])))
    return cut[first], np.add.reduceat(counts, first)


def _parent(nodes: np.ndarray, bit: int) -> np.ndarray:
    """Node with the farthest byte of context left out; a node key has the context above its `bit` bits."""
    mask = np.uint64((1 << bit) - 1)
    return nodes >> np.uint64(8 + bit) << np.uint64(bit) | nodes & mask


def grow(keys: np.ndarray, counts: np.ndarray, depth: int, down_to: int) -> tuple[list[Level], list[tuple]]:
    """Levels `depth` down to `down_to` of the tree, deepest first, from distinct keys in order with their counts.

    Also gives, for each bit, the nodes one level above: key, zeros, ones and the summed logarithm of their children's
    weighted probabilities.
    """
    levels: list[Level] = []
    below: list[tuple] = []
    for length in range(depth, down_to - 1, -1):
        level = Level()
        above = []
        for bit in range(8):
            nodes, zeros, ones = _nodes(keys, counts, bit)
            weighted = estimate = log_estimate(zeros, ones)
            odds = None
            if below:
                odds = np.exp(np.clip(estimate - below[bit][3], -80, 80))
                weighted = np.logaddexp(estimate, below[bit][3]) - np.log(2)
            level.keys.append(nodes)
            level.one.append((ones + 0.5) / (zeros + ones + 1))
            level.odds.append(odds)
            up = _parent(nodes, bit)
            order = np.argsort(up, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], up[order][1:] != up[order][:-1])))
            above.append((up[order][first], *(np.add.reduceat(x[order], first) for x in (zeros, ones, weighted))))
        levels.append(level)
        below = above
        if length > down_to:
            keys, counts = _shorter(keys, counts)
    return levels, below


def top_levels(rows: list[tuple[int, int, float, float, float]], from_length: int) -> list[Level]:
    """Levels above the buckets, from (bit, key, zeros, ones, log) of the nodes with contexts of `from_length`."""
    if not rows:
        return []
    levels: list[Level] = []
    below = []
    for bit in range(8):
        own = sorted(row[1:] for row in rows if row[0] == bit)
        columns = list(zip(*own, strict=True)) or [()] * 4
        below.append(tuple(np.array(x, kind) for x, kind in zip(columns, (np.uint64, float, float, float), strict=True)))
    for length in range(from_length, -1, -1):
        level, above = Level(), []
        for bit in range(8):
            nodes, zeros, ones, children = below[bit]
            estimate = log_estimate(zeros, ones)
            weighted = np.logaddexp(estimate, children) - np.log(2)
            level.keys.append(nodes)
            level.one.append((ones + 0.5) / (zeros + ones + 1))
            level.odds.append(np.exp(np.clip(estimate - children, -80, 80)))
            if length:
                up = _parent(nodes, bit)
                order = np.argsort(up, kind="stable")
                first = np.flatnonzero(np.concatenate(([True], up[order][1:] != up[order][:-1])))
                above.append((up[order][first], *(np.add.reduceat(x[order], first) for x in (zeros, ones, weighted))))
        levels.append(level)
        below = above
    return levels


def log10_probability(keys: np.ndarray, levels: list[Level], depth: int = DEPTH) -> np.ndarray:
    """log10 of the probability of each key's byte after its context; levels from the deepest to the empty context."""
    out = np.zeros(len(keys))
    context, byte = keys >> np.uint64(8), keys & np.uint64(255)
    for bit in range(8):
        so_far = byte >> np.uint64(8 - bit)
        is_one = (byte >> np.uint64(7 - bit) & np.uint64(1)) == 1
        chance = np.full(len(keys), 0.5)
        for up, level in enumerate(levels):
            nodes, one, odds = level.keys[bit], level.one[bit], level.odds[bit]
            if not len(nodes):
                continue
            wanted = context >> np.uint64(8 * up) << np.uint64(bit) | so_far
            at = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
            seen = nodes[at] == wanted
            estimate = np.where(is_one, one[at], 1 - one[at])
            mixed = estimate if odds is None else (odds[at] * estimate + chance) / (odds[at] + 1)
            chance = np.where(seen, mixed, chance)
        out += np.log10(chance)
    return out
