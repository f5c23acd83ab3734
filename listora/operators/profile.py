"""Directory profile: counts, coverage, centres and leader boards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listora.functions.numbers import settled
from listora.functions.text import present
from listora.session import write_out

# What the profile reports on.
DISTINCT_OF = {
    "unique_cities": "city",
    "unique_categories": "category",
    "unique_countries": "country_name",
    "unique_place_ids": "place_id",
}
COVERAGE_OF = {
    "website_pct": "website",
    "facebook_pct": "facebook",
    "instagram_pct": "instagram",
    "phone_pct": "phone",
    "email_pct": "email",
    "booking_link_pct": "booking_link",
}
CENTER_OF = ("ratings", "score")
LEADERS = 15

SKETCH_BITS = 14  # of a distinct sketch
_SKETCH = 10_000  # rank error of the percentile sketch: rows / _SKETCH


def profile_counts(df: DataFrame, columns: dict[str, str] = DISTINCT_OF) -> DataFrame:
    """Rows and distinct values, exactly; a missing column counts zero.

    The columns are laid out as (column, value) lines, which collapse in each
    task before they are shuffled. Only the counts of values reach the second
    step, so a value held by very many rows costs no more than a rare one.
    """
    have = {alias: c for alias, c in columns.items() if c in df.columns}
    pairs = [F.struct(F.lit(a).alias("metric"), F.col(c).cast("string").alias("value"))
             for a, c in have.items()]
    rows = F.struct(F.lit("total_rows").alias("metric"), F.lit("").alias("value"))
    lines = df.select(F.explode(F.array(rows, *pairs)).alias("line")).select("line.*")
    tallied = lines.groupBy("metric", "value").agg(F.count("*").alias("n"))

    def distinct(alias: str) -> Column:
        hit = (F.col("metric") == alias) & F.col("value").isNotNull()
        return F.count(F.when(hit, 1)).alias(alias)

    return tallied.agg(
        F.coalesce(F.sum(F.when(F.col("metric") == "total_rows", F.col("n"))), F.lit(0)).alias(
            "total_rows"
        ),
        *(distinct(alias) for alias in columns),
    )


def distinct_sketches(df: DataFrame, columns: dict[str, str] = DISTINCT_OF) -> DataFrame:
    """(metric, n_rows, sketch): what a batch of listings adds to the distinct counts, in a few kilobytes a metric.

    Keep a table of these, one set a batch, and merge instead of reading the listings
    again. Sketches are built in each task before anything is shuffled.
    """
    have = {alias: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string") for alias, c in columns.items()}
    have = {alias: F.concat(F.lit("="), c) for alias, c in have.items()}  # a sketch passes over empty text
    one = df.agg(
        F.count("*").alias("n_rows"), *(F.hll_sketch_agg(c, SKETCH_BITS).alias(alias) for alias, c in have.items())
    )
    lines = F.array(*(F.struct(F.lit(alias).alias("metric"), "n_rows", F.col(alias).alias("sketch")) for alias in columns))
    return one.select(F.inline(lines))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One line a metric of the sketches of any number of batches, in any order."""
    return sketches.groupBy("metric").agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(metric, n_rows, n_distinct) of merged sketches; the standard error is 1.04 / 2 ** (SKETCH_BITS / 2), 0.8 %."""
    return sketches.select("metric", "n_rows", F.hll_sketch_estimate("sketch").alias("n_distinct"))


def percent(flag: Column) -> Column:
    return settled(100 * F.avg(flag.cast("int")), 1)


def profile_coverage(df: DataFrame, columns: dict[str, str] = COVERAGE_OF) -> DataFrame:
    return df.agg(
        *(
            percent(present(F.col(c)) if c in df.columns else F.lit(False)).alias(alias)
            for alias, c in columns.items()
        )
    )


def profile_status(df: DataFrame) -> DataFrame:
    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False)) if name in df.columns else F.lit(False)

    images = (
        F.coalesce(F.col("images_count") > 0, F.lit(False))
        if "images_count" in df.columns
        else F.lit(False)
    )
    return df.agg(
        percent(flag("is_temporarily_closed")).alias("temporarily_closed_pct"),
        percent(flag("is_permanently_closed")).alias("permanently_closed_pct"),
        percent(images).alias("with_images_pct"),
    )


def _bracketed(lines: DataFrame, brackets: dict[str, tuple[float, float]]) -> DataFrame:
    """(field, value, copies) of the values in each field's bracket; all below it are one line without a value.

    Values above their bracket never reach the shuffle, and those below it are
    summed in each task before.
    """
    low, high = (
        F.coalesce(*(F.when(F.col("field") == field, F.lit(ends[i])) for field, ends in brackets.items())) for i in (0, 1)
    )
    inside = F.when(F.col("value") >= low, F.col("value"))
    return lines.filter(F.col("value") <= high).groupBy("field", inside.alias("value")).agg(F.count("*").alias("copies"))


def _with_ranks(tallied: DataFrame) -> DataFrame:
    """Adds `up_to`, the number of rows of the field up to and with a value.

    Ranges of values are counted apart, and each begins where those before it
    end, so no task orders all values of a field.
    """
    runs = tallied.repartitionByRange("field", F.col("value").asc_nulls_first()).withColumn("run", F.spark_partition_id())
    runs = write_out(runs, "ranges")  # sampling the ranges again could cut them elsewhere
    before = Window.partitionBy("field").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = runs.groupBy("field", "run").agg(F.sum("copies").alias("n"))
    offsets = sizes.select("field", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("field", "run").orderBy(F.col("value").asc_nulls_first())
    return runs.withColumn("_up_to", F.sum("copies").over(within)).join(offsets, ["field", "run"]).select(
        "field", "value", (F.col("_up_to") + F.col("offset")).alias("up_to")
    )


def profile_center(df: DataFrame, fields=CENTER_OF) -> DataFrame:
    """Mean and exact median per field, one line each.

    A percentile sketch brackets the median, one line a field; only values inside
    the bracket are shuffled and ranked, a few hundredths of a percent of all.
    """
    lines = df.select(
        F.explode(
            F.array(
                *(F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value")) for f in fields)
            )
        ).alias("line")
    ).select("line.*").filter(F.col("value").isNotNull())
    margin = 2.0 / _SKETCH
    bracket = F.percentile_approx("value", [0.5 - margin, 0.5 + margin], _SKETCH)
    whole = lines.groupBy("field").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), bracket.alias("bracket")
    ).collect()
    spark = df.sparkSession
    if not whole:
        return spark.createDataFrame([], "field string, mean double, median double")
    ranked = _with_ranks(_bracketed(lines, {row.field: tuple(row.bracket) for row in whole}))
    known = spark.createDataFrame([(row.field, row.n, row.mean) for row in whole], "field string, n long, mean double")
    # the middle row, or the two middle rows
    lower, upper = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("up_to") >= rank, F.col("value")))

    return ranked.join(known, "field").groupBy("field", "mean").agg(
        ((at(lower) + at(upper)) / 2).alias("median")
    )


def leaders(df: DataFrame, column: str | Column, alias: str, limit: int = LEADERS) -> DataFrame:
    """The most frequent values, ties in order of value."""
    value = F.col(column) if isinstance(column, str) else column
    return (
        df.select(value.alias(alias))
        .filter(F.col(alias).isNotNull())
        .groupBy(alias)
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), alias)
        .limit(limit)
    )


_HOST = r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\s]+)"
_BARE_HOST = r"^\s*([^/?#:@\s]+\.[^/?#:@\s]+)(?:[/?#:]|\s*$)"


def domain(url: Column) -> Column:
    """Host name in lower case, without a leading ``www.``; the scheme may be missing."""
    host = F.coalesce(F.nullif(F.regexp_extract(url, _HOST, 1), F.lit("")), F.regexp_extract(url, _BARE_HOST, 1))
    return F.nullif(F.regexp_replace(F.lower(host), r"^www\.", ""), F.lit(""))


def top_domains(df: DataFrame, column: str = "website", limit: int = LEADERS) -> DataFrame:
    return leaders(df, domain(F.col(column)), "domain", limit)
