"""Token-sort ratio: how alike two texts are once their tokens are sorted.

The score is 100 * 2 * LCS / (|a| + |b|), LCS being the length of the longest
common subsequence. All bounds are kept as whole numbers so that a pair lying
exactly on the threshold is judged exactly.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 1000  # thresholds are honoured to three decimals
_CELLS = 4_000_000  # most table cells held at once while scoring a batch


def _codes(texts: list[str], width: int, filler: int) -> np.ndarray:
    out = np.full((len(texts), width), filler, dtype=np.int32)
    for i, text in enumerate(texts):
        out[i, : len(text)] = np.frombuffer(text.encode("utf-32-le"), dtype=np.int32)
    return out


def lcs_of_pairs(left: list[str], right: list[str]) -> np.ndarray:
    """LCS length of each pair outside Spark, one table row at a time for all pairs at once.

    A row follows from the row above by a running maximum, since within a row
    the LCS never falls from left to right.
    """
    n = len(left)
    result = np.zeros(n, dtype=np.int32)
    size = np.array([max(len(a), len(b)) for a, b in zip(left, right)], dtype=np.int64)
    by_size = np.argsort(size, kind="stable")
    start = 0
    while start < n:
        stop = start + 1
        while stop < n and (stop + 1 - start) * (size[by_size[stop]] + 1) <= _CELLS:
            stop += 1
        chosen = by_size[start:stop]
        wide = int(size[chosen].max())
        a = _codes([left[i] for i in chosen], wide, -1)
        b = _codes([right[i] for i in chosen], wide, -2)
        above = np.zeros((len(chosen), wide + 1), dtype=np.int32)
        for row in range(wide):
            here = above.copy()
            np.maximum(here[:, 1:], above[:, :-1] + (b == a[:, row : row + 1]), out=here[:, 1:])
            above = np.maximum.accumulate(here, axis=1)
        result[chosen] = above[:, -1]
        start = stop
    return result


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is worked out once. Lambdas must not look at anything but their own variables: what
    stands outside would be worked out anew for every element."""
    return F.transform(F.array(value), body)[0]


_WORD = 62  # positions of a text in one number, so that sums stay within 64 bits


def _number(value: int) -> Column:
    return F.lit(value).cast("long")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", _number(1), place.cast("int"))


def _ones(count: Column) -> Column:
    return _bit(count) - _number(1)


def _characters(text: Column) -> Column:
    return F.split(text, "")


def _masks(text: Column) -> Column:
    """(keys, masks): each distinct character of a text of up to 62 with the bits of its places. The text's characters are
    sorted, so that one walk gathers the bits of each."""
    spots = F.sort_array(F.transform(_characters(text), lambda c, i: F.struct(c.alias("key"), _bit(i).alias("bits"))))
    start = F.struct(
        F.lit("").alias("key"), _number(0).alias("bits"),
        F.array().cast("array<string>").alias("keys"), F.array().cast("array<bigint>").alias("masks"),
    )

    def step(seen: Column, spot: Column) -> Column:
        again = seen["key"] == spot["key"]
        return F.struct(
            spot["key"].alias("key"),
            F.when(again, seen["bits"].bitwiseOR(spot["bits"])).otherwise(spot["bits"]).alias("bits"),
            F.when(again, seen["keys"]).otherwise(F.concat(seen["keys"], F.array(seen["key"]))).alias("keys"),
            F.when(again, seen["masks"]).otherwise(F.concat(seen["masks"], F.array(seen["bits"]))).alias("masks"),
        )

    return F.aggregate(
        spots, start, step,
        lambda seen: F.struct(
            F.concat(seen["keys"], F.array(seen["key"])).alias("keys"), F.concat(seen["masks"], F.array(seen["bits"])).alias("masks")
        ),
    )


def _in_one_word(short: Column, other: Column) -> Column:
    """LCS by bit vectors (Hyyroe, 2004): a zero in v at a place says that the LCS grows there."""

    def known(x: Column) -> Column:
        masks = F.transform(
            x["other"], lambda c: F.coalesce(F.get(x["told"]["masks"], F.array_position(x["told"]["keys"], c).cast("int") - 1), _number(0))
        )
        # the sum leaves the word where the top place is carried; v holds no place beyond the text
        grown = F.aggregate(
            masks, x["full"],
            lambda v, m: (v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(x["full"]),
        )
        return F.bit_count(x["full"]) - F.bit_count(grown)

    given = F.struct(_masks(short).alias("told"), _characters(other).alias("other"), _ones(F.length(short)).alias("full"))
    return _let(given, known)


def _in_words(short: Column, other: Column) -> Column:
    """The same for longer texts: a vector is a list of words, and sums carry from one to the next."""
    top = _number((1 << _WORD) - 1)

    def bits_of(chars: Column, key: Column) -> Column:
        seen = F.aggregate(
            chars, F.struct(_number(0).alias("bits"), _number(1).alias("place")),
            lambda s, c: F.struct(
                F.when(c == key, s["bits"].bitwiseOR(s["place"])).otherwise(s["bits"]).alias("bits"),
                F.call_function("shiftleft", s["place"], F.lit(1)).alias("place"),
            ),
        )
        return seen["bits"]

    def next_words(words: Column, masks: Column) -> Column:
        def step(so_far: Column, w: Column) -> Column:
            total = w["v"] + w["v"].bitwiseAND(w["m"]) + so_far["carry"]
            kept = total.bitwiseAND(top).bitwiseOR(w["v"].bitwiseAND(F.bitwise_not(w["m"])))
            return F.struct(
                F.concat(so_far["words"], F.array(kept)).alias("words"), F.call_function("shiftright", total, F.lit(_WORD)).alias("carry")
            )

        start = F.struct(F.array().cast("array<bigint>").alias("words"), _number(0).alias("carry"))
        both = F.zip_with(words, masks, lambda v, m: F.struct(v.alias("v"), m.alias("m")))
        return F.aggregate(both, start, step, lambda so_far: so_far["words"])

    def known(x: Column) -> Column:
        masks = F.transform(F.array_distinct(x["chars"]), lambda key: F.struct(
            key.alias("key"), F.transform(x["parts"], lambda part: bits_of(part, key)).alias("masks")))

        def walked(y: Column) -> Column:
            grown = F.aggregate(
                x["other"], F.transform(x["parts"], lambda part: top),
                lambda words, c: F.coalesce(next_words(words, F.get(F.filter(y, lambda one: one["key"] == c), F.lit(0))["masks"]), words),
            )
            last = F.transform(x["parts"], lambda part: _ones(F.size(part)))
            places = F.zip_with(grown, last, lambda v, full: F.bit_count(v.bitwiseAND(full)))
            return F.size(x["chars"]) - F.aggregate(places, F.lit(0), lambda n, more: n + more)

        return _let(masks, walked)

    def cut(chars: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(chars), F.lit(_WORD))
        return F.struct(
            chars.alias("chars"), F.transform(starts, lambda at: F.slice(chars, at, _WORD)).alias("parts"), _characters(other).alias("other")
        )

    return _let(_let(_characters(short), cut), known)


_STEPS = [1 << power for power in range(10, -1, -1)]


def _shared(most: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Characters two texts share at an end, up to `most` and twice the longest step: halving steps, each taken where
    `same` finds its characters equal."""
    steps = F.array(*map(F.lit, _STEPS))
    return F.aggregate(
        steps, F.lit(0), lambda n, step: F.when((n + step <= most) & same(n, step), n + step).otherwise(n)
    )


def _cores(a: Column, b: Column, body: Callable[[Column], Column]) -> Column:
    """The body over (shared, short, other): what two texts share at their ends, and what lies between."""

    def at_front(x: Column) -> Column:
        most = F.least(F.length(x["a"]), F.length(x["b"]))
        n = _shared(most, lambda n, step: F.substring(x["a"], n + 1, step) == F.substring(x["b"], n + 1, step))
        return F.struct(x["a"].alias("a"), x["b"].alias("b"), n.alias("n"), most.alias("most"))

    def at_end(x: Column) -> Column:
        def tail(text: Column, n: Column, step: Column) -> Column:
            return F.substring(text, F.length(text) - n - step + 1, step)

        n = _shared(x["most"] - x["n"], lambda n, step: tail(x["a"], n, step) == tail(x["b"], n, step))
        return F.struct(x["a"].alias("a"), x["b"].alias("b"), x["n"].alias("n"), n.alias("m"))

    def between(x: Column) -> Column:
        left, right = (F.substring(x[side], x["n"] + 1, F.length(x[side]) - x["n"] - x["m"]) for side in ("a", "b"))
        first = F.length(x["a"]) <= F.length(x["b"])
        return F.struct(
            (x["n"] + x["m"]).alias("shared"), F.when(first, left).otherwise(right).alias("short"),
            F.when(first, right).otherwise(left).alias("other"),
        )

    given = F.struct(a.alias("a"), b.alias("b"))
    return _let(_let(_let(_let(given, at_front), at_end), between), body)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, in the JVM; null where either text is null.

    What texts share at their ends is part of it; bit vectors are for the rest.
    """

    def found(x: Column) -> Column:
        size = F.length(x["short"])
        rest = F.when(size == 0, 0).when(size <= _WORD, _in_one_word(x["short"], x["other"])).when(
            size > _WORD, _in_words(x["short"], x["other"])
        )
        return x["shared"] + rest

    return F.when(a.isNotNull() & b.isNotNull(), _cores(a, b, found))


def indels(a: Column, b: Column) -> Column:
    """Fewest insertions and deletions between two texts.

    With an edit distance up to one above the difference in length they follow from it, since they exceed it by at most
    the number of replacements and agree with the difference in parity; other pairs take the common subsequence.
    """
    gap = F.abs(F.length(a) - F.length(b))
    distance = F.levenshtein(a, b)
    return F.when(distance <= gap + 1, 2 * distance - gap).otherwise(F.length(a) + F.length(b) - 2 * lcs_length(a, b))


def ratio(a: Column, b: Column) -> Column:
    """Score of two texts as they stand; two empty texts are equal."""
    total = F.length(a) + F.length(b)
    return F.when(a != b, F.lit(100.0) * (total - indels(a, b)) / total).when(total >= 0, F.lit(100.0))


def scaled(threshold: float) -> int:
    if not 0 < threshold <= 100:
        raise ValueError("threshold must lie in (0, 100]")
    return round(threshold * SCALE)


def allowed_edits(total_length: Column, threshold: float) -> Column:
    """Most insertions plus deletions that still reach the threshold."""
    slack = 100 * SCALE - scaled(threshold)
    return F.call_function("div", total_length.cast("bigint") * slack, F.lit(100 * SCALE))
