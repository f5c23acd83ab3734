"""Double-array tries over phrases of 64-bit word symbols, built once and walked by whole arrays of positions."""

from __future__ import annotations

import numpy as np

_TRIED = 64  # bases that are tried at once
_PATIENCE = 4  # times this is done before there is more room
_LARGE = 8  # children from which a state is placed by itself
ROOT = 0


class DoubleArray:
    """A trie of phrases of one length: ``next = base[state] + symbol``, valid where ``check[next] == state``.

    `phrases` is a matrix of distinct rows of word symbols. `phrase_of` gives the row a state of full depth stands for.
    Symbols get dense numbers from 1, frequent ones first, so that the children of a state lie close together.
    """

    def __init__(self, phrases: np.ndarray):
        self.phrases = phrases
        self.depth = phrases.shape[1]
        self.alphabet, dense = np.unique(phrases, return_inverse=True)
        dense = dense.reshape(phrases.shape)
        often = np.argsort(-np.bincount(dense.ravel(), minlength=len(self.alphabet)), kind="stable")
        self.number = np.empty(len(often), np.int32)
        self.number[often] = np.arange(1, len(often) + 1, dtype=np.int32)
        rows = self.number[dense]
        order = np.lexsort(rows.T[::-1])
        self._build(rows[order], order)

    def arrays(self) -> dict[str, np.ndarray]:
        """All there is to the trie, as plain arrays to be broadcast."""
        return dict(vars(self))

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray]) -> DoubleArray:
        trie = cls.__new__(cls)
        vars(trie).update(arrays)
        return trie

    def _build(self, rows: np.ndarray, order: np.ndarray) -> None:
        width = len(self.alphabet) + 1
        room = width + 2 * rows.size + _TRIED
        self.base = np.zeros(room, np.int32)
        self.check = np.full(room, -1, np.int32)
        self.check[ROOT] = ROOT
        taken = np.zeros(room, bool)
        taken[ROOT] = True
        draw = np.random.default_rng(0)  # the same trie each time
        state = np.zeros(len(rows), np.int64)  # of each phrase, level by level
        for level in range(self.depth):
            if not len(rows):
                break
            symbol = rows[:, level]
            first = np.flatnonzero(np.concatenate(([True], (state[1:] != state[:-1]) | (symbol[1:] != symbol[:-1]))))
            parent, child = state[first], symbol[first]
            start = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
            count = np.diff(np.append(start, len(parent)))
            large = np.flatnonzero(count > _LARGE)
            for at in large[np.argsort(-count[large], kind="stable")]:
                symbols = child[start[at] : start[at] + count[at]].astype(np.int64)
                self._place(parent[start[at]], symbols, taken, draw)
            some = np.flatnonzero((count > 1) & (count <= _LARGE))
            self._scatter(parent[start[some]], start[some], count[some], child, taken, draw)
            single = start[count == 1]  # any free slot does
            free = np.flatnonzero(~taken)[: len(single)]
            if len(free) < len(single):
                free = np.concatenate([free, len(taken) + np.arange(len(single) - len(free))])
                self._widen(taken, int(free[-1]) + _TRIED)
            self.base[parent[single]] = free - child[single]
            self.check[free] = parent[single]
            taken[free] = True
            reached = self.base[parent] + child
            state = np.repeat(reached, np.diff(np.append(first, len(rows)))).astype(np.int64)
        self.phrase_of = np.full(len(self.check), -1, np.int32)
        if len(rows):
            self.phrase_of[state] = order

    def _scatter(self, parents: np.ndarray, start: np.ndarray, count: np.ndarray, child: np.ndarray, taken: np.ndarray, draw: np.random.Generator) -> None:
        """Gives many states a base at once: all draw one, and those whose slots are free and nobody else's have it."""
        room = len(taken) + 2 * int(count.sum())
        self._widen(taken, room)
        while len(parents):
            owner = np.repeat(np.arange(len(parents)), count)
            spot = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            symbols = child[np.repeat(start, count) + spot].astype(np.int64)
            lowest, highest = child[start].astype(np.int64), child[start + count - 1].astype(np.int64)
            base = 1 - lowest + (draw.random(len(parents)) * (room - 1 - (highest - lowest))).astype(np.int64)
            slots = base[owner] + symbols
            _, first = np.unique(slots, return_index=True)
            fine = np.zeros(len(slots), bool)
            fine[first] = True
            fine &= ~taken[slots]
            settled = np.bincount(owner[~fine], minlength=len(parents)) == 0
            mine = settled[owner]
            self.base[parents[settled]] = base[settled]
            self.check[slots[mine]] = parents[owner[mine]]
            taken[slots[mine]] = True
            parents, start, count = parents[~settled], start[~settled], count[~settled]

    def _widen(self, taken: np.ndarray, room: int) -> None:
        self.base = np.concatenate([self.base, np.zeros(room - len(taken), np.int32)])
        self.check = np.concatenate([self.check, np.full(room - len(taken), -1, np.int32)])
        taken.resize(room, refcheck=False)

    def _place(self, parent: int, symbols: np.ndarray, taken: np.ndarray, draw: np.random.Generator) -> None:
        """Gives a state with many children a base at which all of them are free, in more room where none is found."""
        lowest, highest = int(symbols[0]), int(symbols[-1])
        tries = 0
        while True:
            room = len(taken) - 1 - (highest - lowest)
            bases = 1 - lowest + (draw.random(_TRIED) * max(room, 1)).astype(np.int64)
            slots = bases[:, None] + symbols[None, :]
            if slots.max() < len(taken):
                free = np.flatnonzero(~taken[slots].any(axis=1))
                if len(free):
                    chosen = slots[free[0]]
                    self.base[parent] = bases[free[0]]
                    self.check[chosen] = parent
                    taken[chosen] = True
                    return
            tries += 1
            if tries % _PATIENCE == 0 or room < 1:
                self._widen(taken, len(taken) + len(taken) // 4 + highest)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of word symbols in this trie, 0 for those it does not have."""
        if not len(self.alphabet):
            return np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.alphabet, hashes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == hashes, self.number[at], 0).astype(np.int32)

    def walk(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of a text of symbol numbers at which a phrase begins, and the states that accept them.

        All positions advance together, one level at a time; those without a next state leave.
        """
        at = np.flatnonzero(text)
        state = np.zeros(len(at), np.int64)
        for level in range(self.depth):
            inside = at + level < len(text)
            at, state = at[inside], state[inside]
            symbol = text[at + level]
            onward = self.base[state].astype(np.int64) + symbol
            valid = (symbol > 0) & (onward > 0) & (onward < len(self.check))
            at, state, onward = at[valid], state[valid], onward[valid]
            valid = self.check[onward] == state
            at, state = at[valid], onward[valid]
        return at, state
