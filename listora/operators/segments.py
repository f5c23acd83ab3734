"""Segments: k-means, nearest centroid, summaries, labels and briefs."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listora.functions.json_text import strict_json
from listora.functions.numbers import settled
from listora.operators.categories import snippet
from listora.operators.exchange import keyed_requests, with_replies
from listora.operators.features import Encode, feature_matrix
from listora.operators.nearest import assign_nearest
from listora.operators.prompts import (
    BRIEF_SYSTEM,
    SEGMENT_SYSTEM,
    brief_prompt,
    segment_prompt,
    stat_lines,
)
from listora.schema import ROW_ID
from listora.session import write_out
from listora.settings import Settings

# Fields of the replies, agreed with whoever answers the requests.
LABEL_REPLY = "segment_name string, segment_description string"
BRIEF_REPLY = (
    "priority_tier string, key_gaps array<string>, recommended_approach string, "
    "estimated_deal_rationale string"
)
UNKNOWN_TIER = "Unknown"  # fixed value: tier where the brief cannot be read


# ------------------------------------------------------------------ clustering


def fit_segments(
    df: DataFrame,
    settings: Settings = Settings(),
    vectors: DataFrame | None = None,
    encode: Encode | None = None,
) -> tuple[DataFrame, KMeansModel]:
    """Add ``cluster_id`` by k-means over all rows. ``df`` is read more than once:
    hand in a written table. Text vectors: see ``features.feature_matrix``.

    Rows are dealt by their id and ordered in each part before the fit, so that
    starting points and sums, and with them the segments, do not depend on how
    the table came to be partitioned.
    """
    matrix = write_out(feature_matrix(df, settings, vectors, encode), "matrix")  # else each pass would weigh the terms anew
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = matrix.select(ROW_ID, "features").repartition(parts, ROW_ID).sortWithinPartitions(ROW_ID)
    model = KMeans(
        k=settings.n_clusters,
        seed=settings.seed,
        maxIter=settings.max_iterations,
        initMode="k-means||",
        featuresCol="features",
        predictionCol="cluster_id",
    ).fit(dealt.select("features"))
    return model.transform(matrix).drop("features"), model


def fitted_centers(df: DataFrame, model: KMeansModel) -> DataFrame:
    """The model's centres as (cluster_id, centroid)."""
    rows = [(i, center.tolist()) for i, center in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "cluster_id long, centroid array<double>")


def fit_metrics(df: DataFrame, model: KMeansModel, settings: Settings = Settings()) -> dict:
    """How the fit went: the sum of squared distances of all rows to their final
    centre, iterations, and whether the fit ended before their limit."""
    vectors = feature_matrix(df, settings).select(vector_to_array("features").alias("vector"))
    found = assign_nearest(vectors, "vector", fitted_centers(df, model))
    iterations = model.summary.numIter
    return {
        "inertia": found.agg(F.sum("distance2")).first()[0],
        "iterations": iterations,
        "converged": iterations < settings.max_iterations,
    }


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, as (cluster_id, centroid): one pre-aggregated
    shuffle on (group, dimension), whatever the size of a group."""
    cells = df.select(F.col(group).alias("cluster_id"), F.posexplode(vector).alias("dim", "value"))
    means = cells.groupBy("cluster_id", "dim").agg(F.avg("value").alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("dim", "value")))
    return means.groupBy("cluster_id").agg(ordered.getField("value").alias("centroid"))


# ------------------------------------------------------------------- summaries


def segment_stats(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Size, share, means and commonest category of every segment.

    Rows first collapse to one line per (segment, category); the summaries are
    taken from those few lines, so no segment is ever gathered.
    """
    numbers = [f for f in settings.numeric_features if f in df.columns]
    category = F.col("category_llm") if "category_llm" in df.columns else F.lit(None).cast("string")
    lines = df.groupBy("cluster_id", category.alias("category")).agg(
        F.count("*").alias("n"),
        *(F.sum(F.col(f).cast("double")).alias(f"sum_{f}") for f in numbers),
        *(F.count(f).alias(f"n_{f}") for f in numbers),
    )
    commonest = F.struct(-F.col("n"), F.col("category"))
    found = lines.groupBy("cluster_id").agg(
        F.sum("n").alias("size"),
        *(
            settled(F.sum(f"sum_{f}") / F.nullif(F.sum(f"n_{f}"), F.lit(0)), 3).alias(f"avg_{f}")
            for f in numbers
        ),
        F.min_by("category", F.when(F.col("category").isNotNull(), commonest)).alias("top_category"),
    )
    share = settled(100.0 * F.col("size") / F.sum("size").over(Window.partitionBy()), 2)
    return found.select(
        "cluster_id",
        "size",
        share.alias("pct_of_total"),
        *(f"avg_{f}" for f in numbers),
        "top_category",
    )


def segment_samples(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Up to five rows per segment, chosen by seeded digest of the row id. The rank
    filter is applied per task first, so a segment sends five rows a task."""
    draw = F.md5(F.concat_ws(":", F.lit(str(settings.seed)), F.col(ROW_ID).cast("string")))
    chosen = Window.partitionBy("cluster_id").orderBy(draw, ROW_ID)
    return df.withColumn("sample_no", F.row_number().over(chosen)).filter(
        F.col("sample_no") <= settings.samples_per_segment
    )


def stat_columns(stats: DataFrame) -> dict[str, Column]:
    return {c: F.col(c) for c in stats.columns if c != "cluster_id"}


def sample_line(columns, snippet_length: int | None = None) -> Column:
    have = [F.col(c) for c in ("category_llm", "category_normalized") if c in columns]
    return F.concat(
        F.col("sample_no").cast("string"),
        F.lit(". "),
        F.coalesce("name", F.lit("?")),
        F.lit(" | category: "),
        F.coalesce(*have, F.lit("none")),
        F.lit(" | description: "),
        snippet(columns, snippet_length),
    )


def segment_requests(
    stats: DataFrame, samples: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    lines = samples.select("cluster_id", "sample_no", sample_line(samples.columns, settings.snippet_length).alias("line"))
    in_order = F.array_sort(F.collect_list(F.struct("sample_no", "line"))).getField("line")
    members = lines.groupBy("cluster_id").agg(F.array_join(in_order, "\n").alias("members"))
    asked = stats.join(members, "cluster_id", "left").select(
        "cluster_id",
        segment_prompt(
            F.col("cluster_id"),
            stat_lines(stat_columns(stats)),
            F.coalesce("members", F.lit("")),
        ).alias("prompt"),
    )
    return keyed_requests(asked, settings.reasoning_model, SEGMENT_SYSTEM)


# ------------------------------------------------------------- labels and briefs


def _readable(reply: Column) -> Column:
    """The whole reply is one JSON object."""
    return F.coalesce(F.schema_of_variant(strict_json(reply)).startswith("OBJECT"), F.lit(False))


def parse_labels(replies: DataFrame) -> DataFrame:
    """(cluster_id, reply) -> name and description. A reply that is no JSON
    object, or that lacks either, names the segment by number."""
    parsed = F.from_json("reply", LABEL_REPLY)
    name, about = parsed["segment_name"], parsed["segment_description"]
    usable = _readable(F.col("reply")) & name.isNotNull() & about.isNotNull()
    number = F.concat(F.lit("Segment "), F.col("cluster_id").cast("string"))
    return replies.select(
        "cluster_id",
        F.when(usable, name).otherwise(number).alias("segment_name"),
        F.when(usable, about).otherwise(F.col("reply")).alias("segment_description"),
    )


def brief_requests(
    stats: DataFrame, labels: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    asked = stats.join(labels, "cluster_id").select(
        "cluster_id",
        brief_prompt(
            F.col("segment_name"),
            F.col("segment_description"),
            stat_lines(stat_columns(stats)),
        ).alias("prompt"),
    )
    return keyed_requests(asked, settings.reasoning_model, BRIEF_SYSTEM)


def parse_briefs(replies: DataFrame) -> DataFrame:
    """(cluster_id, reply) -> the four parts of a brief, null where one is missing."""
    parsed = F.from_json("reply", BRIEF_REPLY)
    readable = _readable(F.col("reply"))

    def part(name: str, fallback: Column) -> Column:
        return F.when(readable, parsed[name]).otherwise(fallback).alias(name)

    return replies.select(
        "cluster_id",
        part("priority_tier", F.lit(UNKNOWN_TIER)),
        part("key_gaps", F.array().cast("array<string>")),
        part("recommended_approach", F.col("reply")),
        part("estimated_deal_rationale", F.lit("")),
    )


def segment_labels(requests: DataFrame, responses: DataFrame) -> DataFrame:
    return parse_labels(with_replies(requests, responses))


def segment_briefs(requests: DataFrame, responses: DataFrame) -> DataFrame:
    return parse_briefs(with_replies(requests, responses))


def apply_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Label columns onto all rows; hand in written labels, one per segment."""
    return df.join(labels, "cluster_id", "left")


def brief_columns(briefs: DataFrame) -> DataFrame:
    return briefs.select(
        "cluster_id",
        F.col("priority_tier").alias("marketing_priority_tier"),
        F.col("recommended_approach").alias("marketing_recommended_approach"),
    )
