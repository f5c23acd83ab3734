"""Distinct texts, dealt into batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_key(column: str = "text") -> Column:
    """md5 of a text, as binary; null reads as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary")))


def _first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies of a text collapse within an Arrow batch: the least of `least`, the sum of `weight`."""
    for batch in batches:
        place: dict[bytes, int] = {}
        least, weight, kept = [], [], []
        columns = (batch.column(name).to_pylist() for name in ("key", "least", "weight"))
        for i, (key, low, more) in enumerate(zip(*columns, strict=True)):
            at = place.setdefault(key, len(kept))
            if at == len(kept):
                kept.append(i)
                least.append(low)
                weight.append(more)
            else:
                weight[at] += more
                least[at] = min((x for x in (least[at], low) if x is not None), default=None)
        rows = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").take(rows), pa.array(least, pa.int64()), pa.array(weight, pa.int64()), batch.column("text").take(rows)],
            names=["key", "least", "weight", "text"],
        )


def merged_copies(table: pa.Table) -> pa.Table:
    """One row for each key of a batch, with the least `least` and the summed `weight`."""
    merged = table.select(["key", "least", "weight"]).group_by("key", use_threads=False).aggregate([("least", "min"), ("weight", "sum")])
    merged = merged.rename_columns(["key", "least", "weight"])
    first = {key: i for i, key in reversed(list(enumerate(table["key"].to_pylist())))}
    rows = pa.array([first[key] for key in merged["key"].to_pylist()], pa.int64())
    return merged.append_column("text", table["text"].take(rows))


def fresh_names(docs: DataFrame, *names: str) -> list[str]:
    """Column names that the table does not have yet, in any case."""
    taken = {column.lower() for column in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        out.append(name)
    return out


def total_bytes(docs: DataFrame) -> int:
    return docs.select(F.sum(F.octet_length("text")).alias("n")).first().n or 0


def dealt_texts(docs: DataFrame, least: Column, weight: Column, n_batches: int) -> DataFrame:
    """batch, key, least, weight, text of about each distinct text; what is left of copies meets in its batch.

    Copies collapse before they are shuffled, so that a text that a third of all rows share goes along once for each
    Arrow batch of the scan. Use `merged_copies` on a batch to make keys unique.
    """
    rows = docs.select(
        text_key().alias("key"), least.cast("long").alias("least"), weight.cast("long").alias("weight"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    once = rows.mapInArrow(_first_copies, "key binary, least long, weight long, text string")
    return once.withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(n_batches)))
