"""Every operator as a query over the given tables, with its check in SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listora.functions.numbers import settled
from listora.functions.similarity import ratio
from listora.operators import categories, clean, enrich, exchange, features, fuzzy, identity, minibatch
from listora.operators import normalize, profile, segments
from listora.plans import runs
from listora.plans.fixture import cleaned_listings, listings, replies_by_rule, table, typed_listings
from listora.plans.oracle_blocks import NO_ID, compose, guard, has, lcs, settle
from listora.session import prepare, scratch_path, write_out
from listora.settings import Settings
from listora.sources import files, sinks
from listora.streaming import ingest, latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
S = Settings()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: run(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = compose(sql)
        return run

    return register


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich(cleaned_listings(spark, sf_dir))


def by_tier(df: DataFrame) -> DataFrame:
    """A clustering both engines agree on: the number of the review tier."""
    tier = F.col("review_volume_tier")
    number = F.lit(len(enrich.TIER_ORDER) - 1)
    for i, name in enumerate(enrich.TIER_ORDER[:-1]):
        number = F.when(tier == name, i).otherwise(number)
    return df.withColumn("cluster_id", number.cast("bigint"))


def segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_tier(categories.passthrough_categories(enriched(spark, sf_dir)))


# ------------------------------------------------------------------ the flagship


@query("directory_overview", f"""
SELECT category_normalized, city, count(*) AS n_rows, {settle('avg(digital_presence_score)', 4)} AS presence,
  {settle('avg(completeness_score)', 4)} AS completeness, sum(is_active::INT)::BIGINT AS n_active
FROM e_clean GROUP BY category_normalized, city""")
def directory_overview(spark, sf_dir):
    return enriched(spark, sf_dir).groupBy("category_normalized", "city").agg(
        F.count("*").alias("n_rows"),
        settled(F.avg("digital_presence_score"), 4).alias("presence"),
        settled(F.avg("completeness_score"), 4).alias("completeness"),
        F.sum(F.col("is_active").cast("int")).alias("n_active"),
    )


# --------------------------------------------------------------- sources and sinks

CSV_COLUMNS = (
    "row_id name category street_address city zip_code phone email website description "
    "price opening_hours ratings is_temporarily_closed place_id cid"
).split()
CSV_HEADERS = [c.upper().replace("_", " ") for c in CSV_COLUMNS]


@query("scan_csv", f"""
SELECT {', '.join(f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in CSV_COLUMNS)} FROM l_raw""")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "export-csv")
    text = [F.col(c).cast("string").alias(h) for c, h in zip(CSV_COLUMNS, CSV_HEADERS)]
    listings(spark, sf_dir).select(*text).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return normalize.rename_columns(files.scan_csv(spark, path, CSV_HEADERS))


@query("scan_parquet", """
SELECT event_id, user_id, event_type, round(value, 6) AS value, props FROM events""")
def scan_parquet(spark, sf_dir):
    events = files.scan(spark, f"{sf_dir}/events.parquet")
    return events.select(
        "event_id", "user_id", "event_type", F.round("value", 6).alias("value"), "props"
    )


@query("head_n", "SELECT row_id, name, city FROM l_raw ORDER BY row_id LIMIT 100")
def head_n(spark, sf_dir):
    return files.head_n(listings(spark, sf_dir), 100).select("row_id", "name", "city")


STREAM_COLUMNS = (
    "row_id name phone_normalized email_normalized category_normalized is_active has_website "
    "social_media_count days_open_per_week price_bucket review_volume_tier"
).split()


@query("stream_ingest", f"SELECT {', '.join(STREAM_COLUMNS)} FROM e_clean")
def stream_ingest(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    events = ingest.stream_parquet(spark, sf_dir, schema, "events.parquet")
    typed = normalize.coerce_types(listings(spark, sf_dir, events))
    return ingest.drain(enrich.enrich(clean.clean(typed)).select(*STREAM_COLUMNS))


@query("stream_latest", "SELECT row_id, place_id, cid, name, zip_code FROM x_typed_place")
def stream_latest(spark, sf_dir):
    """The latest listing of each place, kept on a stream of events."""
    events = ingest.stream_parquet(spark, sf_dir, table(spark, sf_dir, "events").schema, "events.parquet")
    typed = normalize.coerce_types(listings(spark, sf_dir, events))
    return id_columns(latest.drain_latest(typed, "place_id"))


SINK_COLUMNS = "row_id name category_normalized has_website days_open_per_week price_bucket"


@query("sink_parquet", f"SELECT {SINK_COLUMNS.replace(' ', ', ')}, cluster_id FROM s_clean")
def sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "listings")
    rows = segmented(spark, sf_dir).select(*SINK_COLUMNS.split(), "cluster_id")
    sinks.write_listings(rows, path, partition_by="cluster_id")
    back = files.scan_parquet(spark, path)
    return back.withColumn("cluster_id", F.col("cluster_id").cast("bigint"))


@query("run_metrics", """
SELECT 'rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM s_clean
UNION ALL SELECT 'n_clusters', CAST(count(DISTINCT cluster_id) AS VARCHAR) FROM s_clean
UNION ALL SELECT 'category_mapping_size', CAST(count(DISTINCT category_normalized) AS VARCHAR) FROM s_clean""")
def run_metrics(spark, sf_dir):
    lines = segmented(spark, sf_dir).groupBy("cluster_id", "category_normalized").agg(
        F.count("*").alias("n")
    )
    found = lines.agg(
        F.sum("n").alias("rows"),
        F.count_distinct("cluster_id").alias("n_clusters"),
        F.count_distinct("category_normalized").alias("category_mapping_size"),
    ).first()
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(sinks.metrics_table(spark, found.asDict()), path)
    return spark.read.schema("metric string, value string").json(path)


# ------------------------------------------------------------------ normalisation


@query("rename_columns", """
SELECT row_id, name, street_address, zip_code, is_temporarily_closed, opening_hours,
  place_id, images_count, facebook AS has_flag_raw, city AS my_extra_field FROM l_raw""")
def rename_columns(spark, sf_dir):
    raw = listings(spark, sf_dir).select(
        F.col("row_id"), F.col("name").alias("NAME"),
        F.col("street_address").alias("STREET ADDRESS"), F.col("zip_code").alias("ZIP CODE"),
        F.col("is_temporarily_closed").alias("IS TEMPORARILY CLOSED"),
        F.col("opening_hours").alias("OPENING HOURS"), F.col("place_id").alias("PLACE ID"),
        F.col("images_count").alias("IMAGES COUNT"), F.col("facebook").alias("HAS"),
        F.col("city").alias(" My-Extra Field"),
    )
    return normalize.rename_columns(raw)


@query("coerce_boolean", """
SELECT row_id, is_temporarily_closed, is_permanently_closed FROM l_typed""")
def coerce_boolean(spark, sf_dir):
    return typed_listings(spark, sf_dir).select(
        "row_id", "is_temporarily_closed", "is_permanently_closed"
    )


# Numbers and times as an export spells them; runs on both engines.
SPELLED_SQL = """
SELECT event_id AS row_id,
 CASE event_id % 9 WHEN 0 THEN ' ' || CAST(event_id AS STRING) || '.5 ' WHEN 1 THEN 'n/a' WHEN 2 THEN '1.5d'
   WHEN 3 THEN CAST(event_id AS STRING) || 'e1' WHEN 4 THEN '' WHEN 5 THEN 'nan' WHEN 6 THEN '12,5'
   WHEN 7 THEN '-' || CAST(event_id AS STRING) ELSE props END AS score,
 CASE event_id % 5 WHEN 0 THEN CAST(ts AS STRING) WHEN 1 THEN '2026-03-01'
   WHEN 2 THEN '01.03.2026 10:20' WHEN 3 THEN 'yesterday' ELSE '2026-03-01T04:05:06' END AS collected_at
FROM {events}
"""


def spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SPELLED_SQL, events=table(spark, sf_dir, "events"))


@query("coerce_numeric", f"""
SELECT row_id, CASE WHEN regexp_full_match(trim(score), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')
  THEN try_cast(trim(score) AS DOUBLE) END AS score
FROM ({SPELLED_SQL.format(events='events')})""")
def coerce_numeric(spark, sf_dir):
    return normalize.coerce_types(spelled(spark, sf_dir)).select("row_id", "score")


@query("coerce_timestamp", f"""
SELECT row_id, strftime(coalesce(try_cast(collected_at AS TIMESTAMP),
  try_strptime(collected_at, '%d.%m.%Y %H:%M')), '%Y-%m-%d %H:%M:%S.%f') AS collected_at
FROM ({SPELLED_SQL.format(events='events')})""")
def coerce_timestamp(spark, sf_dir):
    settings = Settings(timestamp_formats=("dd.MM.yyyy HH:mm",))
    typed = normalize.coerce_types(spelled(spark, sf_dir), settings)
    return typed.select(
        "row_id", F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("collected_at")
    )


@query("infer_timestamp", """
SELECT event_id AS row_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS day_first,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS month_first FROM events""")
def infer_timestamp(spark, sf_dir):
    """The times of two exports that differ in their format, each told from its own values."""
    settings = Settings(infer_timestamp_format=True)
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), "ts")

    def read_back(written: str, name: str) -> DataFrame:
        export = events.select("row_id", F.date_format("ts", written).alias("collected_at"))
        typed = normalize.coerce_types(export, settings)
        return typed.select("row_id", F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss").alias(name))

    return read_back("dd/MM/yyyy HH:mm:ss", "day_first").join(read_back("MM/dd/yyyy HH:mm:ss", "month_first"), "row_id")


@query("trim_sentinel", """
SELECT row_id, name, category, street_address, city, region, description, email, website FROM l_typed""")
def trim_sentinel(spark, sf_dir):
    return typed_listings(spark, sf_dir).select(
        "row_id", "name", "category", "street_address", "city", "region", "description",
        "email", "website",
    )


# ----------------------------------------------------------------------- cleaning


@query("clean_name_filter", "SELECT row_id, name FROM l_typed WHERE length(name) >= 2")
def clean_name_filter(spark, sf_dir):
    typed = typed_listings(spark, sf_dir)
    return typed.filter(clean.usable_name(S.min_name_length)).select("row_id", "name")


@query("normalize_phone", "SELECT row_id, phone, phone_normalized FROM l_clean")
def normalize_phone(spark, sf_dir):
    return cleaned_listings(spark, sf_dir).select("row_id", "phone", "phone_normalized")


@query("validate_email", "SELECT row_id, email_normalized, email_syntax_valid FROM l_clean")
def validate_email(spark, sf_dir):
    return cleaned_listings(spark, sf_dir).select(
        "row_id", "email_normalized", "email_syntax_valid"
    )


@query("normalize_category", "SELECT row_id, category_normalized FROM l_clean")
def normalize_category(spark, sf_dir):
    return cleaned_listings(spark, sf_dir).select("row_id", "category_normalized")


@query("drop_closed", "SELECT row_id, name, is_active FROM l_clean WHERE NOT is_permanently_closed")
def drop_closed(spark, sf_dir):
    settings = Settings(drop_permanently_closed=True)
    return clean.clean(typed_listings(spark, sf_dir), settings).select("row_id", "name", "is_active")


@query("is_active", "SELECT row_id, is_active FROM l_clean")
def is_active(spark, sf_dir):
    return cleaned_listings(spark, sf_dir).select("row_id", "is_active")


@query("clamp_ranges", """
SELECT row_id, round(score, 6) AS score, round(lat, 6) AS lat, round(lng, 6) AS lng FROM l_clean""")
def clamp_ranges(spark, sf_dir):
    cleaned = cleaned_listings(spark, sf_dir)
    return cleaned.select("row_id", *(F.round(c, 6).alias(c) for c in ("score", "lat", "lng")))


@query("stage_counts", """
SELECT 'clean' AS stage, (SELECT count(*) FROM l_typed) AS rows_in, (SELECT count(*) FROM l_clean) AS rows_out
UNION ALL SELECT 'exact', (SELECT count(*) FROM l_clean), (SELECT count(*) FROM x_clean)
UNION ALL SELECT 'fuzzy', (SELECT count(*) FROM x_clean), (SELECT count(*) FROM r_clean)""")
def stage_counts(spark, sf_dir):
    return runs.stage_counts(typed_listings(spark, sf_dir))


# -------------------------------------------------------------- entity resolution

ID_COLUMNS = "row_id, place_id, cid, name, zip_code"


def id_columns(df: DataFrame) -> DataFrame:
    return df.select(*ID_COLUMNS.split(", "))


@query("dedup_place_id", f"SELECT {ID_COLUMNS} FROM x_typed_place")
def dedup_place_id(spark, sf_dir):
    return id_columns(identity.latest_per_id(typed_listings(spark, sf_dir), "place_id"))


@query("dedup_exact", f"SELECT {ID_COLUMNS} FROM x_typed")
def dedup_exact(spark, sf_dir):
    return id_columns(identity.dedup_exact(typed_listings(spark, sf_dir)))


@query("no_id_rows", f"SELECT {ID_COLUMNS} FROM l_typed WHERE {NO_ID}")
def no_id_rows(spark, sf_dir):
    return id_columns(identity.without_any_id(typed_listings(spark, sf_dir)))


@query("fuzzy_pairs", """
SELECT r.block, r.row_id AS removed_row, s.row_id AS kept_row, round(e.score, 6) AS score
FROM f_edges e JOIN f_kept_rows s ON s.block = e.block AND s.ord = e.src
JOIN f_keys r ON r.block = e.block AND r.ord = e.dst
WHERE r.row_id NOT IN (SELECT row_id FROM f_kept_rows)
QUALIFY row_number() OVER (PARTITION BY e.block, e.dst ORDER BY e.src) = 1""")
def fuzzy_pairs(spark, sf_dir):
    exact = write_out(runs.cleaned_survivors(typed_listings(spark, sf_dir)), "exact")
    found = fuzzy.fuzzy_matches(exact)
    return found.withColumn("score", F.round("score", 6))


@query("token_sort_ratio", f"""
SELECT row_id, round(CASE WHEN r.a = r.b THEN 100.0 WHEN r.a = '' OR r.b = '' THEN 0.0
  ELSE 200.0 * {lcs('length(r.a)', 'm.masks', 'r.b')} / (length(r.a) + length(r.b)) END, 6) AS score
FROM drift_rows r LEFT JOIN drift_masks m ON m.a = r.a""")
def token_sort_ratio(spark, sf_dir):
    """How far each listing of a place has drifted from the latest one."""
    typed = typed_listings(spark, sf_dir).filter(identity.has_id("place_id", ("place_id",)))
    latest = identity.latest_per_id(typed, "place_id")
    a = typed.select("row_id", "place_id", fuzzy.match_key(typed.columns).alias("a"))
    b = latest.select("place_id", fuzzy.match_key(latest.columns).alias("b"))
    score = F.round(ratio(F.col("a"), F.col("b")), 6)
    return a.join(b, "place_id").select("row_id", score.alias("score"))


@query("fuzzy_dedup", f"SELECT {ID_COLUMNS} FROM r_clean")
def fuzzy_dedup(spark, sf_dir):
    exact = write_out(identity.dedup_exact(cleaned_listings(spark, sf_dir)), "exact")
    return id_columns(fuzzy.dedup_fuzzy(exact, S.block_by, S.fuzzy_threshold))


@query("resolve_entities", f"SELECT {ID_COLUMNS}, city, phone_normalized, is_active FROM r_clean")
def resolve_entities(spark, sf_dir):
    resolved = fuzzy.resolve_entities(cleaned_listings(spark, sf_dir))
    return resolved.select(*ID_COLUMNS.split(", "), "city", "phone_normalized", "is_active")


# --------------------------------------------------------------------- enrichment


def feature_query(name: str, columns: str, rounded: str = "") -> None:
    plain = ["row_id", *columns.split()]
    sql = ", ".join(plain + [f"round({c}, 6) AS {c}" for c in rounded.split()])

    def run(spark, sf_dir):
        return enriched(spark, sf_dir).select(
            *plain, *(F.round(c, 6).alias(c) for c in rounded.split())
        )

    query(name, f"SELECT {sql} FROM e_clean")(run)


FLAGS = " ".join(enrich.PRESENCE_SOURCES)
feature_query("presence_flags", FLAGS)
feature_query("social_count", "social_media_count")
feature_query("digital_presence", "", "digital_presence_score")
feature_query("completeness", "", "completeness_score")
feature_query("days_open", "days_open_per_week")
feature_query("description_length", "description_length")
feature_query("price_bucket", "price_bucket")
feature_query("review_tier", "review_volume_tier")
feature_query(
    "enrich_all",
    f"{FLAGS} social_media_count days_open_per_week description_length price_bucket review_volume_tier",
    "digital_presence_score completeness_score",
)


# --------------------------------------------------------------------- categories


@query("desc_snippet", """
SELECT row_id, substr(coalesce(description, ''), 1, 150) AS snippet FROM l_clean""")
def desc_snippet(spark, sf_dir):
    df = cleaned_listings(spark, sf_dir)
    return df.select("row_id", categories.snippet(df.columns, categories.SNIPPET_LENGTH).alias("snippet"))


@query("distinct_categories", "SELECT category_normalized, snippet, n_rows FROM cat_clean_distinct")
def distinct_categories(spark, sf_dir):
    return categories.distinct_categories(cleaned_listings(spark, sf_dir))


@query("topn_categories", """
SELECT category_normalized, n_rows FROM cat_clean_distinct ORDER BY n_rows DESC, category_normalized LIMIT 3""")
def topn_categories(spark, sf_dir):
    found = categories.distinct_categories(cleaned_listings(spark, sf_dir))
    return categories.top_categories_by_rows(found, 3).select("category_normalized", "n_rows")


def category_requests_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_requests(cleaned_listings(spark, sf_dir))


@query("category_requests", "SELECT category_normalized, prompt FROM cat_clean")
def category_requests(spark, sf_dir):
    return category_requests_of(spark, sf_dir).select("category_normalized", "prompt")


@query("request_keys", "SELECT category_normalized, key FROM cat_clean")
def request_keys(spark, sf_dir):
    return category_requests_of(spark, sf_dir).select("category_normalized", "key")


def asked_and_answered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    asked = write_out(category_requests_of(spark, sf_dir), "requests")
    return asked, replies_by_rule(asked)


@query("cache_hits", "SELECT category_normalized, key, reply AS text FROM cat_clean_replies WHERE key >= '2'")
def cache_hits(spark, sf_dir):
    found = exchange.cache_hits(*asked_and_answered(spark, sf_dir))
    return found.select("category_normalized", "key", "text")


@query("cache_misses", "SELECT category_normalized, key FROM cat_clean WHERE key < '2'")
def cache_misses(spark, sf_dir):
    missing = exchange.cache_misses(*asked_and_answered(spark, sf_dir))
    return missing.select("category_normalized", "key")


@query("cache_append", """
SELECT key, 'kept' AS text, 'succeeded' AS status FROM cat_clean WHERE key >= '8'
UNION ALL SELECT key, reply, 'succeeded' FROM cat_clean_replies WHERE key >= '2' AND key < '8'""")
def cache_append(spark, sf_dir):
    asked, answered = asked_and_answered(spark, sf_dir)
    before = asked.filter(F.col("key") >= "8").select(
        "key", F.lit("kept").alias("text"), F.lit("succeeded").alias("status")
    )
    return exchange.cache_append(before, answered)


@query("label_guard", f"SELECT category_normalized, {guard('reply')} AS category_llm FROM cat_clean_replies")
def label_guard(spark, sf_dir):
    return categories.category_labels(*asked_and_answered(spark, sf_dir))


@query("apply_categories", f"""
SELECT e.row_id, coalesce({guard('c.reply')}, '{S.fallback_label}') AS category_llm
FROM l_clean e LEFT JOIN cat_clean_replies c ON c.category_normalized = e.category_normalized""")
def apply_categories(spark, sf_dir):
    labels = write_out(categories.category_labels(*asked_and_answered(spark, sf_dir)), "labels")
    labelled = categories.apply_categories(cleaned_listings(spark, sf_dir), labels)
    return labelled.select("row_id", "category_llm")


@query("category_passthrough", "SELECT row_id, category_normalized AS category_llm FROM l_clean")
def category_passthrough(spark, sf_dir):
    df = categories.passthrough_categories(cleaned_listings(spark, sf_dir))
    return df.select("row_id", "category_llm")


# ------------------------------------------------------------ features, clustering


@query("combined_text", """
SELECT row_id, coalesce(category, '') || ' | ' || coalesce(description, '') AS text FROM l_clean""")
def combined_text(spark, sf_dir):
    df = cleaned_listings(spark, sf_dir)
    return df.select("row_id", features.combined_text(S.text_features).alias("text"))


@query("distinct_text_stats", f"""
SELECT count(*) AS total_rows, count(DISTINCT text) AS distinct_texts,
  {settle('100 * (1 - count(DISTINCT text) / greatest(count(*), 1)::DOUBLE)', 1)} AS reduction_pct FROM documents""")
def distinct_text_stats(spark, sf_dir):
    return features.distinct_text_stats(table(spark, sf_dir, "documents"), F.col("text"))


@query("map_distinct", """
SELECT doc_id, length(text) AS n_text, len(string_split(text, ' ')) AS n_words FROM documents""")
def map_distinct(spark, sf_dir):
    """Stands for a costly encoder: runs once per distinct text."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = features.map_distinct(
        documents, "text", lambda d: d.withColumn("n_words", F.size(F.split("text", " ", -1)))
    )
    return encoded.select("doc_id", F.length("text").alias("n_text"), "n_words")


def norm(vector) -> Column:
    """Length of a vector, settled to six digits."""
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    return F.round(F.sqrt(squares), 6)


# Hashed terms cannot be told in SQL; that a vector has unit length, and none without words, can.
HAS_WORDS = "regexp_matches(coalesce(category, '') || coalesce(description, ''), '[\\p{L}\\p{N}_]')"


@query("text_features", f"""
SELECT row_id, {S.text_dimensions} AS n_terms, CASE WHEN {HAS_WORDS} THEN 1.0 ELSE 0.0 END::DOUBLE AS length FROM l_clean""")
def text_features(spark, sf_dir):
    df = write_out(
        cleaned_listings(spark, sf_dir).select(
            "row_id", features.combined_text(S.text_features).alias("text")
        ),
        "texts",
    )
    vector = vector_to_array("text_vector")
    return features.text_vectors(df, "text").select(
        "row_id", F.size(vector).alias("n_terms"), norm(vector).alias("length")
    )


@query("zscore_features", f"""
SELECT row_id, {', '.join(f'''round((coalesce({f}, 0) - (SELECT avg(coalesce({f}, 0)) FROM e_clean))
  / (SELECT CASE WHEN stddev_pop(coalesce({f}, 0)) = 0 THEN 1 ELSE stddev_pop(coalesce({f}, 0)) END FROM e_clean), 6) AS z_{f}'''
  for f in S.numeric_features)} FROM e_clean""")
def zscore_features(spark, sf_dir):
    df = write_out(enriched(spark, sf_dir).select("row_id", *S.numeric_features), "numbers")
    scaled = features.zscores(df, S.numeric_features)
    return scaled.select("row_id", *(F.round(f"z_{f}", 6).alias(f"z_{f}") for f in S.numeric_features))


CLUSTER_INPUT = ["row_id", *S.text_features, *S.numeric_features]


def cluster_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_out(enriched(spark, sf_dir).select(*CLUSTER_INPUT), "cluster-input")


Z_SCORES = ", ".join(
    f"""round((coalesce({f}, 0) - (SELECT avg(coalesce({f}, 0)) FROM e_clean))
  / (SELECT CASE WHEN stddev_pop(coalesce({f}, 0)) = 0 THEN 1 ELSE stddev_pop(coalesce({f}, 0)) END FROM e_clean), 6) AS z_{f}"""
    for f in S.numeric_features
)


@query("feature_matrix", f"""
SELECT row_id, {S.text_dimensions + len(S.numeric_features)} AS n_features,
  CASE WHEN {HAS_WORDS} THEN {S.text_weight} ELSE 0.0 END::DOUBLE AS text_length, {Z_SCORES} FROM e_clean""")
def feature_matrix(spark, sf_dir):
    matrix = features.feature_matrix(cluster_input(spark, sf_dir))
    vector = vector_to_array("features")
    return matrix.select(
        "row_id",
        F.size(vector).alias("n_features"),
        norm(F.slice(vector, 1, S.text_dimensions)).alias("text_length"),
        *(F.round(vector[S.text_dimensions + i], 6).alias(f"z_{f}") for i, f in enumerate(S.numeric_features)),
    )


@query("feature_matrix_vectors", f"""
SELECT row_id, len(embedding) + {len(S.numeric_features)} AS n_features,
  round({S.text_weight} * sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 4) AS text_length, {Z_SCORES}
FROM e_clean e JOIN embeddings v ON v.vec_id = ('0x' || left(md5(concat_ws(' | ', {', '.join(f"coalesce({f}, '')" for f in S.text_features)})), 6))::INT
  % (SELECT count(*) FROM embeddings)""")
def feature_matrix_vectors(spark, sf_dir):
    """The given embeddings as text part: each text has the one its digest points at."""
    rows = cluster_input(spark, sf_dir)
    given = table(spark, sf_dir, "embeddings")
    texts = features.distinct_texts(rows.select(features.combined_text(S.text_features).alias("text")), "text")
    pointed = F.conv(F.left(F.md5("text"), F.lit(6)), 16, 10).cast("long") % given.count()
    vectors = texts.withColumn("vec_id", pointed).join(given, "vec_id").select(
        features.digest(F.col("text")).alias("digest"), F.col("embedding").alias("vector")
    )
    vector = vector_to_array("features")
    n_text = F.size(vector) - len(S.numeric_features)
    return features.feature_matrix(rows, vectors=vectors).select(
        "row_id",
        F.size(vector).alias("n_features"),
        F.round(norm(F.slice(vector, F.lit(1), n_text)), 4).alias("text_length"),
        *(F.round(F.get(vector, n_text + i), 6).alias(f"z_{f}") for i, f in enumerate(S.numeric_features)),
    )


def own_vectors(clustered: DataFrame) -> DataFrame:
    """Each row's vector beside its own segment: taken of the clustered rows, so that no vector is joined to its row."""
    rows = write_out(clustered.withColumnRenamed("cluster_id", "own"), "clustered")
    return features.feature_matrix(rows).select("row_id", "own", vector_to_array("features").alias("vector"))


@query("kmeans_fit", "SELECT row_id, true AS at_nearest, true AS in_range FROM e_clean")
def kmeans_fit(spark, sf_dir):
    """Each row with whether it stands in the segment of its nearest centre."""
    rows = cluster_input(spark, sf_dir)
    clustered, model = segments.fit_segments(rows)
    centers = segments.fitted_centers(rows, model)
    vectors = own_vectors(clustered)
    best = segments.assign_nearest(vectors, "vector", centers).withColumnRenamed("cluster_id", "nearest")
    own = best.join(F.broadcast(centers), F.col("own") == F.col("cluster_id"), "left")
    gaps = F.zip_with("vector", "centroid", lambda x, c: (x - c) * (x - c))
    distance = F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x)
    return own.select(
        "row_id",
        (F.abs(distance - F.col("distance2")) <= 1e-6 * (1 + F.col("distance2"))).alias("at_nearest"),
        F.col("own").between(0, S.n_clusters - 1).alias("in_range"),
    )


@query("fit_metrics", """
SELECT count(*) AS n_rows, true AS cost_is_sum_of_distances, true AS limit_is_told FROM e_clean""")
def fit_metrics(spark, sf_dir):
    """What a run is told of its fit, held against distances taken row by row."""
    rows = cluster_input(spark, sf_dir)
    clustered, model = segments.fit_segments(rows)
    told = segments.fit_metrics(rows, model)
    centers = segments.fitted_centers(rows, model)
    own = own_vectors(clustered).join(F.broadcast(centers), F.col("own") == F.col("cluster_id"))
    gaps = F.zip_with("vector", "centroid", lambda x, c: (x - c) * (x - c))
    cost = F.sum(F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x))
    limit_is_told = told["converged"] == (model.summary.numIter < S.max_iterations)
    return own.agg(
        F.count("*").alias("n_rows"),
        (F.abs(cost - told["inertia"]) <= 1e-6 * cost).alias("cost_is_sum_of_distances"),
        F.lit(limit_is_told).alias("limit_is_told"),
    )


@query("kmeans_mini_batch", "SELECT count(*) AS n_rows, count(*)::BIGINT AS weight, true AS near_full_fit FROM embeddings")
def kmeans_mini_batch(spark, sf_dir):
    """A mini-batch fit of the given embeddings, its cost held against that of a full fit."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    centres = minibatch.fit_mini_batch(rows, "vec_id", "vector", S.n_clusters, S.seed)
    full = KMeans(k=S.n_clusters, seed=S.seed, maxIter=S.max_iterations).fit(rows.select(array_to_vector("vector").alias("features")))
    fitted = segments.fitted_centers(rows, full)
    whole = segments.assign_nearest(rows, "vector", fitted).agg(F.sum("distance2")).first()[0]
    weight = centres.agg(F.sum("weight")).first()[0]
    return segments.assign_nearest(rows, "vector", centres.drop("weight")).agg(
        F.count("*").alias("n_rows"),
        F.lit(weight).cast("long").alias("weight"),
        (F.sum("distance2") <= 1.05 * whole).alias("near_full_fit"),
    )


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return segments.assign_nearest(
        vectors, "embedding", segments.centroids(vectors, "label", "embedding")
    )


@query("assign_nearest", "SELECT vec_id, cluster_id::BIGINT AS cluster_id, round(distance2, 4) AS distance2 FROM v_nearest")
def assign_nearest(spark, sf_dir):
    return nearest(spark, sf_dir).select(
        "vec_id", "cluster_id", F.round("distance2", 4).alias("distance2")
    )


@query("inertia", "SELECT count(DISTINCT cluster_id) AS n_clusters, round(sum(distance2), 3) AS inertia FROM v_nearest")
def inertia(spark, sf_dir):
    return nearest(spark, sf_dir).agg(
        F.count_distinct("cluster_id").alias("n_clusters"),
        F.round(F.sum("distance2"), 3).alias("inertia"),
    )


# ------------------------------------------------------ segments, labels and briefs

AVERAGES = [f"avg_{f}" for f in S.numeric_features]


@query("segment_size", "SELECT cluster_id, size, pct_of_total FROM g_clean_stats")
def segment_size(spark, sf_dir):
    return segments.segment_stats(segmented(spark, sf_dir)).select(
        "cluster_id", "size", "pct_of_total"
    )


@query("segment_means", f"SELECT cluster_id, {', '.join(AVERAGES)} FROM g_clean_stats")
def segment_means(spark, sf_dir):
    return segments.segment_stats(segmented(spark, sf_dir)).select("cluster_id", *AVERAGES)


@query("segment_mode", "SELECT cluster_id, top_category FROM g_clean_stats")
def segment_mode(spark, sf_dir):
    return segments.segment_stats(segmented(spark, sf_dir)).select("cluster_id", "top_category")


@query("segment_samples", "SELECT cluster_id, sample_no, row_id, name FROM g_clean_samples")
def segment_samples(spark, sf_dir):
    return segments.segment_samples(segmented(spark, sf_dir)).select(
        "cluster_id", "sample_no", "row_id", "name"
    )


def segment_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = write_out(segmented(spark, sf_dir), "segmented")
    stats = write_out(segments.segment_stats(rows), "stats")
    asked = write_out(segments.segment_requests(stats, segments.segment_samples(rows)), "asked")
    return stats, asked


@query("segment_requests", "SELECT cluster_id, prompt, key FROM g_clean_ask")
def segment_requests(spark, sf_dir):
    return segment_tables(spark, sf_dir)[1]


@query("parse_labels", "SELECT cluster_id, segment_name, segment_description FROM g_clean_labels")
def parse_labels(spark, sf_dir):
    asked = segment_tables(spark, sf_dir)[1]
    return segments.segment_labels(asked, replies_by_rule(asked))


@query("apply_labels", """
SELECT row_id, cluster_id, segment_name, segment_description FROM s_clean JOIN g_clean_labels USING (cluster_id)""")
def apply_labels(spark, sf_dir):
    asked = segment_tables(spark, sf_dir)[1]
    labels = write_out(segments.segment_labels(asked, replies_by_rule(asked)), "labels")
    return segments.apply_labels(segmented(spark, sf_dir), labels).select(
        "row_id", "cluster_id", "segment_name", "segment_description"
    )


def brief_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    stats, asked = segment_tables(spark, sf_dir)
    labels = write_out(segments.segment_labels(asked, replies_by_rule(asked)), "labels")
    return stats, labels, write_out(segments.brief_requests(stats, labels), "brief-asked")


@query("brief_requests", "SELECT cluster_id, prompt, key FROM g_clean_brief")
def brief_requests(spark, sf_dir):
    return brief_tables(spark, sf_dir)[2]


@query("parse_briefs", """
SELECT cluster_id, priority_tier, key_gaps, recommended_approach, estimated_deal_rationale FROM g_clean_briefs""")
def parse_briefs(spark, sf_dir):
    asked = brief_tables(spark, sf_dir)[2]
    briefs = segments.segment_briefs(asked, replies_by_rule(asked))
    return briefs.withColumn("key_gaps", F.array_join("key_gaps", ", "))


@query("segment_report", """
SELECT -1::BIGINT AS position, '# Marketing Intelligence Report' || chr(10) || chr(10) || 'Total businesses analyzed: **'
  || format('{:,}', sum(size)::BIGINT) || '**' || chr(10) || 'Segments identified: **' || count(*) || '**' || chr(10) AS block
FROM g_clean_stats
UNION ALL
SELECT cluster_id, '## Segment ' || cluster_id || ': ' || segment_name || chr(10) || segment_description || chr(10) || chr(10)
  || '- **Size:** ' || format('{:,}', size) || ' (' || pct_of_total || '%)' || chr(10)
  || '- **Priority tier:** ' || coalesce(priority_tier, 'N/A') || chr(10)
  || CASE WHEN key_gaps <> '' THEN '- **Key gaps:** ' || key_gaps || chr(10) ELSE '' END
  || '- **Recommended approach:** ' || coalesce(recommended_approach, 'N/A') || chr(10)
  || '- **Deal rationale:** ' || coalesce(estimated_deal_rationale, 'N/A') || chr(10)
FROM g_clean_stats JOIN g_clean_labels USING (cluster_id) JOIN g_clean_briefs USING (cluster_id)""")
def segment_report(spark, sf_dir):
    stats, labels, asked = brief_tables(spark, sf_dir)
    briefs = segments.segment_briefs(asked, replies_by_rule(asked))
    return sinks.segment_report(stats, labels, briefs)


# ------------------------------------------------------------------------ profile


@query("profile_counts", """
SELECT count(*) AS total_rows, count(DISTINCT city) AS unique_cities, count(DISTINCT category) AS unique_categories,
  count(DISTINCT country_name) AS unique_countries, count(DISTINCT place_id) AS unique_place_ids FROM l_typed""")
def profile_counts(spark, sf_dir):
    return profile.profile_counts(typed_listings(spark, sf_dir))


@query("profile_sketches", """
SELECT metric, (SELECT count(*) FROM l_typed)::BIGINT AS n_rows, true AS within_bound
FROM (VALUES ('unique_cities'), ('unique_categories'), ('unique_countries'), ('unique_place_ids')) AS m(metric)""")
def profile_sketches(spark, sf_dir):
    """Distinct counts merged from the sketches of four batches, held against the exact ones."""
    rows = write_out(typed_listings(spark, sf_dir).select("row_id", *profile.DISTINCT_OF.values()), "profiled")
    batches = [profile.distinct_sketches(rows.filter(F.col("row_id") % 4 == i)) for i in range(4)]
    kept = write_out(functools.reduce(DataFrame.unionByName, batches), "sketches")
    exact = profile.profile_counts(rows).select(
        F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("exact")) for m in profile.DISTINCT_OF)))
    )
    told = profile.distinct_estimates(profile.merged_sketches(kept)).join(exact, "metric")
    within = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.03 * F.col("exact")
    return told.select("metric", "n_rows", within.alias("within_bound"))


@query("profile_coverage", "SELECT " + ", ".join(
    f"{settle(f'100 * avg(({has(c)})::INT)', 1)} AS {c}_pct"
    for c in ("website", "facebook", "instagram", "phone", "email", "booking_link")) + " FROM l_typed")
def profile_coverage(spark, sf_dir):
    return profile.profile_coverage(typed_listings(spark, sf_dir))


@query("profile_center", """
SELECT 'ratings' AS field, round(avg(ratings), 6) AS mean, round(median(ratings), 6) AS median FROM l_typed
UNION ALL SELECT 'score', round(avg(score), 6), round(median(score), 6) FROM l_typed""")
def profile_center(spark, sf_dir):
    found = profile.profile_center(typed_listings(spark, sf_dir))
    return found.select("field", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


@query("profile_status", f"""
SELECT {settle('100 * avg(is_temporarily_closed::INT)', 1)} AS temporarily_closed_pct,
  {settle('100 * avg(is_permanently_closed::INT)', 1)} AS permanently_closed_pct,
  {settle('100 * avg(coalesce(images_count > 0, false)::INT)', 1)} AS with_images_pct FROM l_typed""")
def profile_status(spark, sf_dir):
    return profile.profile_status(typed_listings(spark, sf_dir))


@query("top_categories", """
SELECT category, count(*) AS n_rows FROM l_typed WHERE category IS NOT NULL
GROUP BY category ORDER BY n_rows DESC, category LIMIT 20""")
def top_categories(spark, sf_dir):
    return profile.leaders(typed_listings(spark, sf_dir), "category", "category", 20)


@query("top_cities", """
SELECT city, count(*) AS n_rows FROM l_typed WHERE city IS NOT NULL
GROUP BY city ORDER BY n_rows DESC, city LIMIT 20""")
def top_cities(spark, sf_dir):
    return profile.leaders(typed_listings(spark, sf_dir), "city", "city", 20)


def domains_sql(source: str, column: str) -> str:
    named = f"nullif(regexp_extract({column}, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\\s]+)', 1), '')"
    bare = f"regexp_extract({column}, '^\\s*([^/?#:@\\s]+\\.[^/?#:@\\s]+)(?:[/?#:]|\\s*$)', 1)"
    host = f"regexp_replace(lower(coalesce({named}, {bare})), '^www\\.', '')"
    return f"""
SELECT nullif({host}, '') AS domain, count(*) AS n_rows FROM {source} WHERE nullif({host}, '') IS NOT NULL
GROUP BY 1 ORDER BY n_rows DESC, domain LIMIT 15"""


@query("top_domains", domains_sql("l_typed", "website"))
def top_domains(spark, sf_dir):
    return profile.top_domains(typed_listings(spark, sf_dir))


@query("top_page_domains", domains_sql("pages", "url"))
def top_page_domains(spark, sf_dir):
    return profile.top_domains(table(spark, sf_dir, "pages"), "url")


# --------------------------------------------------------------------- whole runs

RUN_COLUMNS = (
    "row_id name phone_normalized email_normalized category_normalized is_active "
    f"{FLAGS} social_media_count days_open_per_week price_bucket review_volume_tier category_llm"
).split()


@query("run_offline", f"""
SELECT {', '.join(RUN_COLUMNS)}, round(digital_presence_score, 6) AS digital_presence_score,
  round(completeness_score, 6) AS completeness_score
FROM (SELECT *, category_normalized AS category_llm FROM e_resolved)""")
def run_offline(spark, sf_dir):
    done = runs.offline(typed_listings(spark, sf_dir))
    return done.select(
        *RUN_COLUMNS,
        *(F.round(c, 6).alias(c) for c in ("digital_presence_score", "completeness_score")),
    )


@query("run_offline_segmented", """
SELECT row_id, name, category_normalized AS category_llm, true AS in_range FROM e_resolved""")
def run_offline_segmented(spark, sf_dir):
    done = runs.offline_segmented(typed_listings(spark, sf_dir))
    in_range = F.col("cluster_id").between(0, S.n_clusters - 1)
    return done.select("row_id", "name", "category_llm", in_range.alias("in_range"))


@query("open_requests", f"""
SELECT key, '{S.bulk_model}' AS model, prompt FROM cat_resolved WHERE key < '2'
UNION ALL SELECT key, '{S.reasoning_model}', prompt FROM g_resolved_ask WHERE key < '2'
UNION ALL SELECT key, '{S.reasoning_model}', prompt FROM g_resolved_brief WHERE key < '2'""")
def open_requests(spark, sf_dir):
    """Requests of a run that have no usable reply yet."""
    done = runs.with_responses(typed_listings(spark, sf_dir), replies_by_rule, assign=by_tier)
    return done.requests.select("key", "model", "prompt")


@query("run_with_responses", """
SELECT row_id, category_llm, cluster_id, segment_name, segment_description,
  priority_tier AS marketing_priority_tier, recommended_approach AS marketing_recommended_approach
FROM s_resolved JOIN g_resolved_labels USING (cluster_id) JOIN g_resolved_briefs USING (cluster_id)""")
def run_with_responses(spark, sf_dir):
    done = runs.with_responses(typed_listings(spark, sf_dir), replies_by_rule, assign=by_tier)
    return done.listings.select(
        "row_id", "category_llm", "cluster_id", "segment_name", "segment_description",
        "marketing_priority_tier", "marketing_recommended_approach",
    )
