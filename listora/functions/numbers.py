"""Rounding that does not depend on how a sum was split over tasks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STEADY_DIGITS = 9


def settled(c: Column, digits: int) -> Column:
    """Rounded half to even, after cutting what differs with the order of adding.

    Sums of doubles differ in their last digits from run to run. Cut to nine
    digits first, a value on the edge falls to the same side every time, and
    texts built on it (prompts, and so their keys) stay the same.
    """
    return F.bround(F.round(c, STEADY_DIGITS), digits)
