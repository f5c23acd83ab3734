"""Sinks: enriched listings, run metrics and the segment report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOT_GIVEN = "N/A"  # fixed value: shown where a brief has no such part


def write_listings(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def metrics_table(spark: SparkSession, metrics: dict) -> DataFrame:
    """Run metrics as text: whatever a value is, it is written as it prints."""
    rows = [(str(k), None if v is None else str(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "metric string, value string")


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)


def _or_not_given(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(NOT_GIVEN))


def _line(label: str, text: Column) -> Column:
    return F.concat(F.lit(f"- **{label}:** "), text)


def segment_report(stats: DataFrame, labels: DataFrame, briefs: DataFrame) -> DataFrame:
    """One row per line block of the report: (position, block), the header first,
    then the segments in order of their id. Title, names of the lines and their order
    are fixed values: reports are read by them."""
    header = stats.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n"), F.count("*").alias("k"))
    header = header.select(
        F.lit(-1).cast("bigint").alias("position"),
        F.concat(
            F.lit("# Marketing Intelligence Report\n\nTotal businesses analyzed: **"),
            F.format_number("n", 0),
            F.lit("**\nSegments identified: **"),
            F.col("k").cast("string"),
            F.lit("**\n"),
        ).alias("block"),
    )
    gaps = F.array_join("key_gaps", ", ")
    size = F.concat(
        F.format_number("size", 0), F.lit(" ("), F.col("pct_of_total").cast("string"), F.lit("%)")
    )
    block = F.concat_ws(
        "\n",
        F.concat(F.lit("## Segment "), F.col("cluster_id").cast("string"), F.lit(": "),
                 F.col("segment_name")),
        F.concat(F.col("segment_description"), F.lit("\n")),
        _line("Size", size),
        _line("Priority tier", _or_not_given("priority_tier")),
        F.when(F.size("key_gaps") > 0, _line("Key gaps", gaps)),
        _line("Recommended approach", _or_not_given("recommended_approach")),
        F.concat(_line("Deal rationale", _or_not_given("estimated_deal_rationale")), F.lit("\n")),
    )
    segments = (
        stats.select("cluster_id", "size", "pct_of_total")
        .join(labels, "cluster_id")
        .join(briefs, "cluster_id", "left")
        .select(F.col("cluster_id").cast("bigint").alias("position"), block.alias("block"))
    )
    return header.unionByName(segments)


def write_report(report: DataFrame, path: str) -> None:
    """The report as one text file; it has one row per segment."""
    report.orderBy("position").select("block").coalesce(1).write.mode("overwrite").text(path)
