"""Text and numeric features for clustering."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import (
    IDF,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    RegexTokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listora.functions.numbers import settled
from listora.session import write_out
from listora.settings import Settings

TEXT_SEPARATOR = " | "  # fixed value: between the text fields


def combined_text(fields) -> Column:
    return F.concat_ws(TEXT_SEPARATOR, *(F.coalesce(F.col(f), F.lit("")) for f in fields))


def digest(text: Column) -> Column:
    """Stands in for a text in a shuffle: 64 characters however long the text."""
    return F.sha2(text, 256)


def distinct_text_stats(df: DataFrame, text: Column) -> DataFrame:
    """How much encoding only distinct texts saves."""
    counts = df.groupBy(digest(text).alias("digest")).agg(F.count("*").alias("n"))
    total, distinct = F.sum("n"), F.count("*")
    return counts.agg(
        F.coalesce(total, F.lit(0)).alias("total_rows"),
        distinct.alias("distinct_texts"),
        settled(100 * (1 - distinct / F.greatest(total, F.lit(1))), 1).alias("reduction_pct"),
    )


def distinct_texts(df: DataFrame, column: str) -> DataFrame:
    """One column with each text once, null left out.

    The first row of each digest is taken within each task before the shuffle, so a
    text that very many rows hold travels once from each, and none is put into an
    aggregation buffer.
    """
    told = df.filter(F.col(column).isNotNull()).select(column, digest(F.col(column)).alias("_digest"))
    place = F.row_number().over(Window.partitionBy("_digest").orderBy("_digest"))
    return told.withColumn("_place", place).filter(F.col("_place") == 1).select(column)


Encode = Callable[[Iterator[list[str]]], Iterator[np.ndarray]]


def encoded(df: DataFrame, column: str, encode: Encode) -> DataFrame:
    """(digest, vector): what an encoder makes of each distinct text, written out.

    ``encode`` runs in the tasks: it gets the texts in batches and returns a matrix
    for each, so a model is loaded once a task and meets each text once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: deque[pa.Array] = deque()

        def texts() -> Iterator[list[str]]:
            for batch in batches:
                if len(batch):
                    keys.append(batch.column("digest"))
                    yield batch.column("text").to_pylist()

        for matrix in encode(texts()):
            rows = [np.asarray(row, dtype=np.float64) for row in matrix]
            yield pa.RecordBatch.from_arrays(
                [keys.popleft(), pa.array(rows, pa.list_(pa.float64()))], names=["digest", "vector"]
            )

    each = distinct_texts(df, column).select(digest(F.col(column)).alias("digest"), F.col(column).alias("text"))
    return write_out(each.mapInArrow(run, "digest string, vector array<double>"), "encoded")


def given_vectors(df: DataFrame, column: str, vectors: DataFrame) -> tuple[DataFrame, int]:
    """Add ``text_vector`` from a table (digest, vector), and say how long vectors are.

    ``vectors`` has each digest once. A text without a vector gets zeros.
    """
    size = vectors.agg(F.max(F.size("vector")).alias("n")).first().n
    if not size or size < 1:
        raise ValueError("the table holds no vector")
    lookup = vectors.select(F.col("digest").alias("_digest"), F.col("vector").cast("array<double>").alias("_vector"))
    none = F.array_repeat(F.lit(0.0), size)
    found = df.withColumn("_digest", digest(F.col(column))).join(lookup, "_digest", "left")
    return found.withColumn("text_vector", array_to_vector(F.coalesce("_vector", none))).drop("_digest", "_vector"), size


def map_distinct(
    df: DataFrame, column: str, encode: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Run a costly step once per distinct text and join the result back.

    ``encode`` gets a one-column table and returns it with columns added. The
    lookup side holds each text once, so a text held by very many rows makes
    only the row side of the join uneven, which Spark splits by itself.
    """
    lookup = encode(distinct_texts(df, column))
    lookup = lookup.withColumn("_digest", digest(F.col(column))).drop(column)
    return (
        df.withColumn("_digest", digest(F.col(column)))
        .join(lookup, "_digest", "left")
        .drop("_digest")
    )


def text_vectors(df: DataFrame, column: str, settings: Settings = Settings()) -> DataFrame:
    """Unit-length TF-IDF vectors of a fixed number of hashed terms.

    Hashing is cheaper than the shuffle that finds distinct texts, so it runs on
    the rows; a model-based encoder runs on distinct texts (``encoded``).
    """
    words = RegexTokenizer(inputCol=column, outputCol="_words", pattern=r"(?U)\W+")
    terms = HashingTF(inputCol="_words", outputCol="_terms", numFeatures=settings.text_dimensions)
    counted = terms.transform(words.transform(df))
    weights = IDF(inputCol="_terms", outputCol="_weighted").fit(counted)
    unit = Normalizer(inputCol="_weighted", outputCol="text_vector", p=2.0)
    return unit.transform(weights.transform(counted)).drop("_words", "_terms", "_weighted")


def zscores(df: DataFrame, fields) -> DataFrame:
    """Add ``z_<field>``: null counts as 0, population deviation, 0 if constant.

    Mean and deviation of all fields come from one aggregate over ``df``, whose
    single row is then written into the expressions.
    """
    value = {f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in fields}
    moments = df.agg(
        *(F.avg(v).alias(f"mean_{f}") for f, v in value.items()),
        *(F.stddev_pop(v).alias(f"dev_{f}") for f, v in value.items()),
    ).first()

    def scaled(f: str) -> Column:
        mean, dev = moments[f"mean_{f}"], moments[f"dev_{f}"]
        return (value[f] - F.lit(mean)) / F.lit(dev if dev else 1.0)

    return df.select("*", *(scaled(f).alias(f"z_{f}") for f in fields))


def feature_matrix(
    df: DataFrame,
    settings: Settings = Settings(),
    vectors: DataFrame | None = None,
    encode: Encode | None = None,
) -> DataFrame:
    """Add ``features``: text vector, weighted down if numbers join it, then z-scores.

    Text vectors are hashed terms unless ``vectors`` has them by the digest of the
    combined text (``digest``, ``combined_text``), or ``encode`` makes them of each
    distinct text.
    """
    if vectors is not None and encode is not None:
        raise ValueError("either vectors or an encoder")
    texts = [f for f in settings.text_features if f in df.columns]
    numbers = [f for f in settings.numeric_features if f in df.columns]
    if not texts and not numbers:
        raise ValueError("neither a text nor a numeric feature column is present")
    columns = df.columns
    parts: list[str] = []
    if numbers:
        df = zscores(df, numbers)
        parts += [f"z_{f}" for f in numbers]
    if texts:
        df = df.withColumn("_text", combined_text(texts))
        if encode is not None:
            vectors = encoded(df, "_text", encode)
        if vectors is not None:
            df, dimensions = given_vectors(df, "_text", vectors)
        else:
            df, dimensions = text_vectors(df, "_text", settings), settings.text_dimensions
        if not numbers:
            parts.append("text_vector")
        else:
            weight = Vectors.dense([settings.text_weight] * dimensions)
            scale = ElementwiseProduct(
                scalingVec=weight, inputCol="text_vector", outputCol="_scaled_text"
            )
            df = scale.transform(df)
            parts.insert(0, "_scaled_text")
    return VectorAssembler(inputCols=parts, outputCol="features").transform(df).select(
        *columns, "features"
    )
