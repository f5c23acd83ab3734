"""Entity resolution by stable id: latest row per place id, then per cid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listora.functions.text import not_blank
from listora.schema import ID_COLUMNS, ROW_ID, TIMESTAMP_COLUMN


def has_id(name: str, columns) -> Column:
    return not_blank(F.col(name)) if name in columns else F.lit(False)


def has_any_id(columns) -> Column:
    return has_id("place_id", columns) | has_id("cid", columns)


def newest_first(columns) -> list[Column]:
    order = []
    if TIMESTAMP_COLUMN in columns:
        order.append(F.col(TIMESTAMP_COLUMN).desc_nulls_last())
    return order + [F.col(ROW_ID).asc()]


def latest_per_id(df: DataFrame, id_column: str, first: list[Column] = ()) -> DataFrame:
    """Keep one row per id, and every row that has none.

    A row without id forms a group of its own, named by its row id, so the
    rows lacking an id spread over all tasks instead of meeting in one, and one
    scan serves both kinds. ``row_number() = 1`` is limited per id before the
    shuffle: a hot id sends at most one row from each task.
    """
    if id_column not in df.columns:
        return df
    with_id = has_id(id_column, df.columns)
    group = Window.partitionBy(
        F.when(with_id, F.col(id_column)), F.when(~with_id, F.col(ROW_ID))
    ).orderBy(*first, *newest_first(df.columns))
    return (
        df.withColumn("_place_in_group", F.row_number().over(group))
        .filter(F.col("_place_in_group") == 1)
        .drop("_place_in_group")
    )


def exact_survivors(df: DataFrame) -> DataFrame:
    """Row ids, which are unique, of the rows that ``dedup_exact`` keeps. Only ids
    and times are sorted and shuffled, whatever else the rows hold."""
    return dedup_exact(df.select(ROW_ID, *(c for c in (*ID_COLUMNS, TIMESTAMP_COLUMN) if c in df.columns))).select(ROW_ID)


def scans_repeat(df: DataFrame) -> bool:
    """Whether the rows are the same in a second scan: ids that are numbered in the plan itself need not be."""
    return df._jdf.queryExecution().analyzed().deterministic()


def dedup_exact(df: DataFrame) -> DataFrame:
    """One row per place id, then one per cid.

    In the second pass a row with a place id wins over a newer row without.
    """
    place, cid = ID_COLUMNS
    df = latest_per_id(df, place)
    return latest_per_id(df, cid, [has_id(place, df.columns).desc()])


def without_any_id(df: DataFrame) -> DataFrame:
    return df.filter(~has_any_id(df.columns))


def processing_order(columns) -> Column:
    """The order rows stand in after exact resolution, as one ascending key."""
    if TIMESTAMP_COLUMN in columns:
        age = -F.unix_micros(F.col(TIMESTAMP_COLUMN).cast("timestamp"))
    else:
        age = F.lit(None).cast("bigint")
    return F.struct(
        (~has_id("cid", columns)).alias("no_cid"),
        (~has_id("place_id", columns)).alias("no_place"),
        age.isNull().alias("undated"),
        age.alias("age"),
        F.col(ROW_ID).alias(ROW_ID),
    )
