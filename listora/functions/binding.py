"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often it is used.

    Inside the branches of a ``when`` Spark would work it out anew each time.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
