"""Typing of a freshly scanned export: names, booleans, numbers, times, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listora.functions.text import trim_ws
from listora.schema import (
    BOOLEAN_COLUMNS,
    NUMERIC_COLUMNS,
    ROW_ID,
    TIMESTAMP_COLUMN,
    TRIMMED_COLUMNS,
    column_names,
)
from listora.settings import Settings

# Text read as false, and text that stands for a missing value.
FALSE_WORDS = ("false", "0", "no", "n", "")
MISSING_WORDS = ("nan", "None")
# Formats an export's times may be in, day first before month first.
TIMESTAMP_FORMATS = tuple(
    f"{date}{time}"
    for date in ("dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy", "MM-dd-yyyy", "yyyy/MM/dd")
    for time in (" HH:mm:ss", " HH:mm", "")
)
_NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def rename_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(column_names(df.columns))


def to_boolean(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        known = c
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        known = (c != 0) & ~F.isnan(c)
    elif isinstance(dtype, T.NumericType):
        known = c != 0
    else:
        known = ~F.lower(trim_ws(c)).isin(*FALSE_WORDS)
    return F.coalesce(known, F.lit(False))


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Double or null. The pattern keeps out spellings only the cast accepts."""
    if isinstance(dtype, T.StringType):
        number = F.when(c.rlike(_NUMBER), c.try_cast("double"))
    else:
        number = c.cast("double")
    return F.when(~F.isnan(number), number)


def to_time(c: Column, dtype: T.DataType, formats: tuple[str, ...] = ()) -> Column:
    """Timestamp or null: ISO text first, then each given format in turn."""
    if not isinstance(dtype, T.StringType):
        return c.cast("timestamp")
    tries = [F.try_to_timestamp(c)] + [F.try_to_timestamp(c, F.lit(f)) for f in formats]
    return F.coalesce(*tries)


def inferred_format(df: DataFrame, column: str, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> str | None:
    """The one format that reads the most values of a text column; None for ISO text.

    All formats are tried in one aggregate over the column. Ties go to ISO text, then
    to the earlier format; so a column whose days are all below 13 is read by the
    first format that fits it.
    """
    c = F.col(column)
    tried = df.agg(
        F.count(F.try_to_timestamp(c)).alias("iso"),
        *(F.count(F.try_to_timestamp(c, F.lit(f))).alias(f"f{i}") for i, f in enumerate(formats)),
    ).first()
    best = max(range(-1, len(formats)), key=lambda i: (tried["iso" if i < 0 else f"f{i}"], -i))
    return None if best < 0 else formats[best]


def to_text(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = F.when(~F.isnan(c), c)
    text = trim_ws(c.cast("string"))
    return F.when(~text.isin(*MISSING_WORDS), text)


def coerce_types(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    typed: dict[str, Column] = {}
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name in BOOLEAN_COLUMNS:
            typed[field.name] = to_boolean(c, field.dataType)
        elif field.name in NUMERIC_COLUMNS:
            typed[field.name] = to_number(c, field.dataType)
        elif field.name == TIMESTAMP_COLUMN:
            if settings.infer_timestamp_format and isinstance(field.dataType, T.StringType):
                found = inferred_format(df, field.name, settings.timestamp_formats or TIMESTAMP_FORMATS)
                typed[field.name] = F.try_to_timestamp(c, F.lit(found)) if found else F.try_to_timestamp(c)
            else:
                typed[field.name] = to_time(c, field.dataType, settings.timestamp_formats)
        elif field.name in TRIMMED_COLUMNS:
            typed[field.name] = to_text(c, field.dataType)
    return df.withColumns(typed)


def with_row_id(df: DataFrame) -> DataFrame:
    """Number the rows where the source has no key of its own.

    The number follows the scan: file split, then position in the split. It
    repeats as long as the same files are read with the same split size, so
    write the numbered table out before using it in more than one job if the
    folder may change.
    """
    if ROW_ID in df.columns:
        return df
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


def normalize(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Everything a scanned export needs before cleaning."""
    return with_row_id(coerce_types(rename_columns(df), settings))
