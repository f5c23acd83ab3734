"""Strict reading of JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_json(c: Column) -> Column:
    """The value as a variant, null unless the whole text is one JSON value.

    The parser ignores what follows a complete value, so ``9-17 mon`` could pass
    as a number. Parsed once inside an array and once inside an object, only a
    lone, complete value is valid both times.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    return F.when(in_array.isNotNull(), F.try_variant_get(in_object, "$.v", "variant"))
