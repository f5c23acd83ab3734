"""Category canonicalisation: work on distinct values, join the labels back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listora.functions.text import trim_ws
from listora.operators.exchange import keyed_requests, with_replies
from listora.operators.identity import processing_order
from listora.operators.prompts import CATEGORY_SYSTEM, category_prompt
from listora.settings import Settings

SNIPPET_LENGTH = 150  # fixed value: characters of the snippet feature


def snippet(columns, length: int | None = None) -> Column:
    """The description, or its first characters where a length is given."""
    if "description" not in columns:
        return F.lit("")
    whole = F.coalesce("description", F.lit(""))
    return whole if length is None else F.substring(whole, 1, length)


def distinct_categories(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each category with its row count and the snippet of its first row.

    The first row is found by rank, which each task limits to one row a category
    before the shuffle; texts never sit in an aggregate's buffer. A table without
    categories has none.
    """
    if "category_normalized" not in df.columns:
        none = "category_normalized string, snippet string, n_rows long"
        return df.sparkSession.createDataFrame([], none)
    named = df.filter(F.col("category_normalized").isNotNull())
    order = Window.partitionBy("category_normalized").orderBy("place")
    first = (
        named.select(
            "category_normalized",
            snippet(df.columns, settings.snippet_length).alias("snippet"),
            processing_order(df.columns).alias("place"),
        )
        .withColumn("rank", F.row_number().over(order))
        .filter("rank = 1")
        .select("category_normalized", "snippet")
    )
    counts = named.groupBy("category_normalized").agg(F.count("*").alias("n_rows"))
    return first.join(counts, "category_normalized")


def top_categories_by_rows(categories: DataFrame, limit: int) -> DataFrame:
    """The most frequent categories, a report of its own."""
    return categories.orderBy(F.desc("n_rows"), "category_normalized").limit(limit)


def category_requests(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A request for each category. With ``max_category_requests`` set only the
    most frequent are asked about; the others keep their rule-based value."""
    chosen = distinct_categories(df, settings)
    if settings.max_category_requests is not None:
        chosen = top_categories_by_rows(chosen, settings.max_category_requests)
    asked = chosen.select(
        "category_normalized",
        "snippet",
        category_prompt(
            F.col("category_normalized"), F.col("snippet"), settings.taxonomy
        ).alias("prompt"),
    )
    return keyed_requests(asked, settings.bulk_model, CATEGORY_SYSTEM)


def guarded_label(reply: Column, settings: Settings = Settings()) -> Column:
    """The reply if it is a label of the taxonomy, else the fallback."""
    label = trim_ws(reply)
    return F.when(label.isin(*settings.taxonomy), label).otherwise(settings.fallback_label)


def category_labels(
    requests: DataFrame, responses: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    return with_replies(requests, responses).select(
        "category_normalized", guarded_label(F.col("reply"), settings).alias("category_llm")
    )


def apply_categories(
    df: DataFrame, labels: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Labels onto all rows; a category that was not asked about keeps its value.
    Hand in written labels: their size is then known before planning."""
    if "category_normalized" not in df.columns:
        return df.withColumn("category_llm", F.lit(settings.fallback_label))
    return df.join(labels, "category_normalized", "left").withColumn(
        "category_llm",
        F.coalesce("category_llm", "category_normalized", F.lit(settings.fallback_label)),
    )


def passthrough_categories(df: DataFrame) -> DataFrame:
    rule_based = (
        F.col("category_normalized")
        if "category_normalized" in df.columns
        else F.lit(None).cast("string")
    )
    return df.withColumn("category_llm", rule_based)
