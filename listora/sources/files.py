"""Sources: CSV and Parquet exports, optionally only their first rows."""

from __future__ import annotations

import functools
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from listora.operators.normalize import normalize, with_row_id
from listora.schema import ROW_ID
from listora.session import prepare
from listora.settings import Settings

# Every column is text; only an empty field is null. Quotes inside a field are
# doubled. A file whose header differs from the columns expected is refused, as
# its fields would land under the wrong names.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "enforceSchema": False}


def text_schema(headers) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType()) for h in headers])


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    headers: list[str] | list[list[str]] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Text columns as they stand in the file. With ``headers`` given, nothing is
    read before the job itself.

    Exports with several column orders: give a list of paths, each with files of
    one layout (and a list of their headers). They are united by column name, and
    a column that a layout lacks is null. Files of one path must have one header.

    Fields that span lines keep a file from being split, so each file is one
    task. Where no field holds a line break, ``multi_line=False`` lets Spark
    split large files.
    """
    if not isinstance(path, str):
        layouts = headers or [None] * len(path)
        parts = [scan_csv(spark, p, h, multi_line) for p, h in zip(path, layouts, strict=True)]
        return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    reader = prepare(spark).read.options(**CSV_OPTIONS, multiLine=multi_line)
    if headers:
        reader = reader.schema(text_schema(headers))
    return reader.csv(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return prepare(spark).read.parquet(path)


def scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """By file extension, as the rest of the path says nothing about the format."""
    if PurePosixPath(path).suffix.lower() == ".parquet":
        return scan_parquet(spark, path)
    return scan_csv(spark, path, multi_line=multi_line)


def head_n(df: DataFrame, n: int) -> DataFrame:
    """The first n rows by row id."""
    return df.orderBy(ROW_ID).limit(n)


def load(
    spark: SparkSession,
    path: str,
    rows: int | None = None,
    settings: Settings = Settings(),
    multi_line: bool = True,
) -> DataFrame:
    """Scan, optionally cut to the first rows, and normalise."""
    df = with_row_id(scan(spark, path, multi_line))
    if rows:
        df = head_n(df, rows)  # each task keeps its first rows, so the scan is not sorted as a whole
    return normalize(df, settings)
