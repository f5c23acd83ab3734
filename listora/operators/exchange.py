"""Request and response tables: what is asked of a language model, and what came
back. Nothing is called from here. One job writes requests, something outside
answers them into a response table, a later job joins the answers.

requests:  key, prompt, and whatever names the subject
responses: key, text, status
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCEEDED = "succeeded"  # fixed value: the status of a usable response
KEY_SEPARATOR = "::"  # fixed value: between model, system text and prompt


def request_key(model: Column, system: Column, prompt: Column) -> Column:
    """SHA-256 of model, system text and prompt: equal requests share a key."""
    parts = [F.coalesce(p, F.lit("")) for p in (model, system, prompt)]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def keyed_requests(df: DataFrame, model: str, system: str) -> DataFrame:
    return df.withColumn("key", request_key(F.lit(model), F.lit(system), F.col("prompt")))


def usable(responses: DataFrame) -> DataFrame:
    """One succeeded response per key; the lowest text where several came in."""
    return (
        responses.filter(F.col("status") == SUCCEEDED)
        .groupBy("key")
        .agg(F.min("text").alias("text"))
    )


def cache_hits(requests: DataFrame, stored: DataFrame) -> DataFrame:
    return requests.join(usable(stored), "key")


def cache_misses(requests: DataFrame, stored: DataFrame) -> DataFrame:
    return requests.join(usable(stored), "key", "left_anti")


def cache_append(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """The stored responses plus the newly succeeded ones."""
    new = usable(arrived).join(stored, "key", "left_anti")
    return stored.unionByName(new.withColumn("status", F.lit(SUCCEEDED)).select(*stored.columns))


def with_replies(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Every request with its reply, empty where none succeeded."""
    replies = usable(responses).withColumnRenamed("text", "reply")
    return requests.join(replies, "key", "left").withColumn(
        "reply", F.coalesce("reply", F.lit(""))
    )
