"""Days open per week out of the opening-hours text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listora.functions.binding import let
from listora.functions.json_text import strict_json
from listora.functions.text import not_blank

# Day names searched for in text that is not JSON.
DAY_NAMES = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
# JSON values that count as closed, besides any spelling of zero.
CLOSED_VALUES = ("null", '""', "false", "[]", "{}")
_ZERO = r"^-?0(\.0+)?([eE][+-]?[0-9]+)?$"


def _is_open(value: Column) -> Column:
    text = F.to_json(value)
    return ~(text.isin(*CLOSED_VALUES) | text.rlike(_ZERO))


# JSON text that is neither object nor array: it lists no days.
_PLAIN_VALUE = (
    r"^[ \t\r\n]*(?:null|true|false|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
    r'|"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*")[ \t\r\n]*\z'
)
_OBJECT_OR_ARRAY = r"^[ \t\r\n]*[{\[]"


def days_open(c: Column) -> Column:
    """JSON object: its filled-in values; JSON array: its length; other JSON: 0;
    anything else: how many day names the text mentions. Only text that begins
    like an object or array is parsed."""
    mentioned = sum(F.contains(F.lower(c), F.lit(d)).cast("int") for d in DAY_NAMES)

    def listed(value: Column) -> Column:
        by_key = F.try_variant_get(value, "$", "map<string,variant>")
        entries = F.try_variant_get(value, "$", "array<variant>")
        return (
            F.when(value.isNull(), mentioned)
            .when(F.schema_of_variant(value).startswith("OBJECT"),
                  F.size(F.filter(F.map_values(by_key), _is_open)))
            .otherwise(F.size(entries))
        )

    return (
        F.when(~not_blank(c), F.lit(0))
        .when(c.rlike(_OBJECT_OR_ARRAY), let(strict_json(c), listed))
        .when(c.rlike(_PLAIN_VALUE), F.lit(0))
        .otherwise(mentioned)
    )
