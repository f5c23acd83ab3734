import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from listora.operators import categories, exchange, features, normalize, profile, segments
from listora.operators.enrich import enrich
from listora.plans import runs
from listora.plans.catalog import by_tier, cluster_input
from listora.plans.fixture import listings, replies_by_rule, typed_listings
from listora.schema import EXPORT_HEADERS, column_names
from listora.session import scratch_path, write_out
from listora.settings import TAXONOMY, Settings
from listora.sources import files, sinks
from listora.streaming import ingest


def test_absent_columns_are_not_counted(spark):
    df = spark.createDataFrame([("n", " ")], "name string, website string")
    row = enrich(df).first()
    assert row.completeness_score == 0.5
    assert not row.has_website and not row.has_instagram and row.digital_presence_score == 0.0
    assert "price_bucket" not in row.asDict() and "days_open_per_week" not in row.asDict()


def test_review_tiers_close_on_the_right(spark):
    values = [None, -5.0, -1.0, -0.5, 0.0, 1.0, 5.0, 5.5, 20.0, 21.0, 100.0, 100.5]
    df = spark.createDataFrame([(v,) for v in values], "ratings double")
    got = [r.review_volume_tier for r in enrich(df).collect()]
    assert got == [
        "none", None, None, "none", "none", "very_low", "very_low", "low", "low", "moderate",
        "moderate", "high",
    ]


def test_an_invalid_email_still_counts(spark):
    df = spark.createDataFrame([("x", None), (" ", None)], "email string, email_normalized string")
    assert [r.has_email for r in enrich(df).collect()] == [True, False]


def test_request_key_keeps_its_separators(spark):
    import hashlib

    df = spark.createDataFrame([("m", None, "p")], "a string, b string, c string")
    key = df.select(exchange.request_key(F.col("a"), F.col("b"), F.col("c")).alias("k")).first().k
    assert key == hashlib.sha256(b"m::::p").hexdigest()


def test_responses(spark):
    asked = spark.createDataFrame([("k1", "p1"), ("k2", "p2"), ("k3", "p3")], "key string, prompt string")
    came = spark.createDataFrame(
        [("k1", "yes", "succeeded"), ("k2", "no", "errored"), ("k1", "yes", "succeeded")],
        "key string, text string, status string",
    )
    assert [r.key for r in exchange.cache_hits(asked, came).collect()] == ["k1"]
    assert sorted(r.key for r in exchange.cache_misses(asked, came).collect()) == ["k2", "k3"]
    replies = {r.key: r.reply for r in exchange.with_replies(asked, came).collect()}
    assert replies == {"k1": "yes", "k2": "", "k3": ""}
    stored = spark.createDataFrame([("k1", "old", "succeeded")], came.schema)
    assert [(r.key, r.text) for r in exchange.cache_append(stored, came).collect()] == [("k1", "old")]


def test_label_guard(spark):
    values = [f" {TAXONOMY[2]}\n", "Detox", "", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.x for r in df.select(categories.guarded_label(F.col("v")).alias("x")).collect()]
    assert got == ["Detox Center"] + ["Other / Unclear"] * 3


def test_category_cap_keeps_the_most_frequent(spark):
    rows = [(i, "A" if i < 5 else "B" if i < 8 else "C") for i in range(10)]
    df = spark.createDataFrame(rows, "row_id long, category_normalized string")
    asked = categories.category_requests(df, Settings(max_category_requests=2))
    assert sorted(r.category_normalized for r in asked.collect()) == ["A", "B"]


def test_replies_that_cannot_be_read(spark):
    good = json.dumps({"segment_name": "N", "segment_description": "D"})
    replies = [good, "no json", '{"segment_name": "N"}', "[1]", good + " and more", "", "'x'"]
    df = spark.createDataFrame(list(enumerate(replies)), "cluster_id long, reply string")
    got = {r.cluster_id: (r.segment_name, r.segment_description)
           for r in segments.parse_labels(df).collect()}
    assert got[0] == ("N", "D")
    assert all(got[i] == (f"Segment {i}", replies[i]) for i in range(1, len(replies)))
    long = spark.createDataFrame([(1, "x" * 400)], "cluster_id long, reply string")
    assert segments.parse_labels(long).first().segment_description == "x" * 400


def test_briefs(spark):
    replies = [
        '{"priority_tier": "High", "key_gaps": ["a", "b"], "recommended_approach": "r", "estimated_deal_rationale": "e"}',
        '{"priority_tier": "Low"}',
        "no json",
    ]
    df = spark.createDataFrame(list(enumerate(replies)), "cluster_id long, reply string")
    got = [tuple(r)[1:] for r in segments.parse_briefs(df).orderBy("cluster_id").collect()]
    assert got == [
        ("High", ["a", "b"], "r", "e"), ("Low", None, None, None), ("Unknown", [], "no json", ""),
    ]


def test_zscores_use_the_population(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "a double, b double")
    got = [(r.z_a, r.z_b) for r in features.zscores(df, ["a", "b"]).collect()]
    values = np.array([1.0, 3.0, 0.0])
    wanted = (values - values.mean()) / values.std()
    assert np.allclose([g[0] for g in got], wanted) and [g[1] for g in got] == [0.0, 0.0, 0.0]


def test_kmeans_puts_rows_at_their_nearest_centre(spark, sf_dir):
    settings = Settings(n_clusters=5)
    source = cluster_input(spark, sf_dir)
    clustered, model = segments.fit_segments(source, settings)
    matrix = features.feature_matrix(source, settings)
    assigned = {r.row_id: r.cluster_id for r in clustered.select("row_id", "cluster_id").collect()}
    centres = np.array(model.clusterCenters())
    cost = 0.0
    for r in matrix.select("row_id", "features").collect():
        distance = ((centres - r.features.toArray()) ** 2).sum(axis=1)
        assert distance[assigned[r.row_id]] <= distance.min() + 1e-9
        cost += distance.min()
    assert len(assigned) == source.count()
    assert cost <= model.summary.trainingCost * (1 + 1e-9)


def test_text_vectors_are_unit_length(spark):
    df = spark.createDataFrame([("a b",), ("a c c",), ("d",)], "t string")
    rows = features.text_vectors(df, "t", Settings(text_dimensions=32)).collect()
    assert np.allclose([np.linalg.norm(r.text_vector.toArray()) for r in rows], 1.0)


def test_nearest_centroid_prefers_the_lower_id(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([2.0, 0.0],)], "v array<double>")
    centres = spark.createDataFrame(
        [(3, [1.0, 0.0]), (1, [-1.0, 0.0])], "cluster_id long, centroid array<double>"
    )
    got = [(r.cluster_id, r.distance2) for r in segments.assign_nearest(df, "v", centres).collect()]
    assert got == [(1, 1.0), (3, 1.0)]


def test_map_distinct_encodes_each_text_once(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    seen = []

    def encode(texts):
        seen.append(texts.count())
        return texts.withColumn("n", F.length("t"))

    got = features.map_distinct(df, "t", encode).collect()
    assert seen == [2] and sorted((r.t or "", r.n) for r in got) == [("", None), ("a", 1), ("a", 1), ("b", 1)]


def test_medians_are_exact(spark):
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 1000, 1001):
        values = np.round(rng.normal(size=n), 2).tolist()
        df = spark.createDataFrame([(v, None) for v in values] + [(None, None)], "score double, ratings double")
        got = {r.field: (r.mean, r.median) for r in profile.profile_center(df).collect()}
        assert set(got) == {"score"}
        assert np.allclose(got["score"], (np.mean(values), np.median(values)))


def test_domains(spark):
    urls = ["https://WWW.A.de/x?y#z", "http://b.com:80/", "no url", None, "https://www.xn--die.de"]
    urls += ["foo.de", "www.foo.de/x", "https://a_b.de/x", " http://u:p@c.de:8/", "localhost", "two words.de"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r.d for r in df.select(profile.domain(F.col("u")).alias("d")).collect()]
    assert got == ["a.de", "b.com", None, None, "xn--die.de", "foo.de", "foo.de", "a_b.de", "c.de", None, None]


def test_csv_round_trip(spark):
    path = scratch_path(spark, "csv")
    rows = [
        ('say "hi"', "NA", '{"mon": "9-17"}', "line one\nline two"),
        ("", "null", None, " padded "),
    ]
    df = spark.createDataFrame(rows, ["NAME", "CITY", "OPENING HOURS", "DESCRIPTION"])
    df.coalesce(1).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    got = files.scan_csv(spark, path).collect()
    assert [tuple(r) for r in got] == [rows[0], (None, "null", None, " padded ")]
    loaded = files.load(spark, path, rows=1).collect()
    assert len(loaded) == 1 and loaded[0].description == "line one\nline two"


def test_every_header_has_its_own_column():
    names = column_names(EXPORT_HEADERS)
    assert len(set(names.values())) == 53 and names["HAS"] == "has_flag_raw"


def test_stream_takes_up_new_files_only(spark, sf_dir):
    folder, table, progress = (scratch_path(spark, n) for n in ("in", "table", "progress"))
    text = [F.col(c).cast("string").alias(c.upper()) for c in ("row_id", "name", "place_id")]
    raw = listings(spark, sf_dir).select(*text)
    headers = raw.columns

    def add(df):
        df.coalesce(1).write.mode("append").options(header=True, escape='"').csv(folder)

    add(raw.filter("CAST(ROW_ID AS INT) < 300"))
    stream = ingest.stream_csv(spark, folder, headers, files_per_batch=1)
    assert ingest.drain(stream, table, progress).count() == 300
    add(raw.filter("CAST(ROW_ID AS INT) >= 300"))
    assert ingest.drain(stream, table, progress).count() == raw.count()


def test_report_file(spark, sf_dir):
    done = runs.with_responses(typed_listings(spark, sf_dir), replies_by_rule, assign=by_tier)
    path = scratch_path(spark, "report")
    sinks.write_report(done.report, path)
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    assert text.startswith("# Marketing Intelligence Report\n\nTotal businesses analyzed: **")
    ids = [r.cluster_id for r in done.stats.orderBy("cluster_id").collect()]
    assert [f"## Segment {i}:" in text for i in ids] == [True] * len(ids)
    positions = [text.index(f"## Segment {i}:") for i in ids]
    assert positions == sorted(positions)
    metrics = {r.metric: r.value for r in done.metrics.collect()}
    assert int(metrics["rows"]) == done.listings.count()


def test_run_without_any_reply(spark, sf_dir):
    nothing = spark.createDataFrame([], "key string, text string, status string")
    done = runs.with_responses(typed_listings(spark, sf_dir), runs.stored(nothing), assign=by_tier)
    rows = done.listings.select("cluster_id", "category_llm", "segment_name", "marketing_priority_tier")
    assert all(
        r.category_llm == "Other / Unclear" and r.segment_name == f"Segment {r.cluster_id}"
        and r.marketing_priority_tier == "Unknown"
        for r in rows.collect()
    )
    assert done.requests.count() == done.stats.count() * 2 + int(
        {r.metric: r.value for r in done.metrics.collect()}["category_mapping_size"]
    )


def test_prompts_do_not_depend_on_partitioning(spark, sf_dir):
    from listora.plans.catalog import segmented

    rows = write_out(segmented(spark, sf_dir), "rows")
    keys = []
    for parts in (1, 7, 13):
        spread = rows.repartition(parts)
        stats = segments.segment_stats(spread)
        asked = segments.segment_requests(stats, segments.segment_samples(spread))
        keys.append(sorted(r.key for r in asked.collect()))
    assert keys[0] == keys[1] == keys[2]




def test_nan_is_not_true(spark):
    df = spark.createDataFrame([(float("nan"), float("nan")), (1.0, 0.0)], "is_temporarily_closed double, name double")
    rows = normalize.coerce_types(df).collect()
    assert [r.is_temporarily_closed for r in rows] == [False, True]
    assert rows[0]["name"] is None


def test_column_orders_do_not_mix(spark, tmp_path):
    for name, text in (("a", "NAME,CITY\nx,Hamburg\n"), ("b", "CITY,NAME\nBerlin,y\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(text)
    both = files.scan_csv(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert sorted(map(tuple, both.select("NAME", "CITY").collect())) == [("x", "Hamburg"), ("y", "Berlin")]
    with pytest.raises(Exception, match="header"):
        files.scan_csv(spark, f"{tmp_path}/b", ["NAME", "CITY"]).collect()


def test_categories_left_out_keep_their_value(spark):
    rows = [(i, f"C{i % 7}", "long text " * 60) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, category_normalized string, description string")
    asked = categories.category_requests(df)
    assert asked.count() == 7 and asked.first().snippet == "long text " * 60
    few = Settings(max_category_requests=2)
    labels = categories.category_labels(categories.category_requests(df, few), spark.createDataFrame([], "key string, text string, status string"))
    got = {r.category_normalized: r.category_llm for r in categories.apply_categories(df, labels, few).collect()}
    assert sum(value == "Other / Unclear" for value in got.values()) == 2
    assert sum(value == name for name, value in got.items()) == 5
    assert categories.category_requests(df.drop("category_normalized")).count() == 0


def test_first_rows_follow_the_scan(spark, tmp_path):
    (tmp_path / "f.csv").write_text("NAME\n" + "".join(f"n{i}\n" for i in range(50)))
    assert [r["name"] for r in files.load(spark, f"{tmp_path}/f.csv", rows=3).collect()] == ["n0", "n1", "n2"]


def test_segments_do_not_depend_on_partitions(spark, sf_dir):
    rows = write_out(cluster_input(spark, sf_dir), "rows")
    found = []
    for parts in (1, 4, 9):
        clustered, model = segments.fit_segments(write_out(rows.repartition(parts), "rows"))
        found.append(sorted(map(tuple, clustered.select("row_id", "cluster_id").collect())))
        told = segments.fit_metrics(rows, model)
        assert told["iterations"] > 0 and told["converged"] == (told["iterations"] < Settings().max_iterations)
    assert found[0] == found[1] == found[2]


def test_second_run_has_no_open_requests(spark, sf_dir):
    df = write_out(typed_listings(spark, sf_dir), "listings")

    def half(requests):
        status = F.when(F.col("key") < "8", "errored").otherwise("succeeded")
        return replies_by_rule(requests).withColumn("status", status)

    first = runs.with_responses(df, half, assign=by_tier)
    asked = first.requests.collect()
    assert asked and all(row.model and row.system and row.prompt for row in asked)
    known = {row.key for row in first.responses.collect()}
    assert known.isdisjoint(row.key for row in asked)

    def everything(requests):
        return replies_by_rule(requests).withColumn("status", F.lit("succeeded"))

    done = runs.with_responses(df.drop("instagram"), everything, assign=by_tier)
    assert done.requests.isEmpty()
    told = {row.metric: row.value for row in done.metrics.collect()}
    assert told["open_requests"] == "0" and told["categories_not_asked"] == "0"
    assert any(key.startswith("segment_") for key in told)
