"""The listing view: a business directory derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from listora.operators.clean import clean
from listora.operators.normalize import coerce_types
from listora.session import prepare

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The same text runs on Spark and on the checking engine.
LISTING_SQL = """
SELECT e.event_id AS row_id,
 CASE WHEN e.event_id % 97 = 0 THEN NULL WHEN e.event_id % 50 = 3 THEN 'X' ELSE c.c_name END AS name,
 CASE WHEN e.event_id % 31 = 0 THEN NULL ELSE '  ' || e.event_type || '/in center ' END AS category,
 CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE CAST(e.user_id % 9 + 1 AS STRING) || ' Main St' END AS street_address,
 n.n_name AS city, r.r_name AS region,
 CASE WHEN e.event_id % 37 = 0 THEN NULL ELSE lpad(CAST(e.user_id % 20 AS STRING), 5, '0') END AS zip_code,
 CASE e.event_id % 5 WHEN 0 THEN '+49 30 ' || CAST(1000000 + e.user_id AS STRING) WHEN 1 THEN '030/' || CAST(1000000 + e.user_id AS STRING)
   WHEN 2 THEN '0049 (30) ' || CAST(1000000 + e.user_id AS STRING) WHEN 3 THEN 'call us' ELSE NULL END AS phone,
 CASE WHEN e.event_id % 5 = 0 THEN '' WHEN e.event_id % 7 = 0 THEN 'not-an-email' ELSE ' ' || e.event_type || CAST(e.user_id AS STRING) || '@Example.com' END AS email,
 CASE WHEN e.event_id % 3 = 0 THEN NULL WHEN e.event_id % 41 = 0 THEN 'nan' WHEN e.event_id % 7 = 0 THEN 'www.site' || CAST(e.user_id % 17 AS STRING) || '.example.de/p' WHEN e.event_id % 8 = 0 THEN 'http://my_shop' || CAST(e.user_id % 3 AS STRING) || '.example.de:8080' ELSE 'https://www.site' || CAST(e.user_id % 17 AS STRING) || '.example.de/p?x=1' END AS website,
 CASE WHEN e.event_id % 4 = 0 THEN '' ELSE 'Offers ' || e.event_type || ' in ' || n.n_name END AS description,
 CASE WHEN e.event_id % 9 = 0 THEN '$$$$$' WHEN e.event_id % 8 = 0 THEN '' ELSE '$$' END AS price,
 CASE e.event_id % 6 WHEN 0 THEN '{{"mon": "9-17", "tue": "", "wed": "9-17", "thu": null, "fri": 0, "sat": [], "sun": "0"}}' WHEN 1 THEN '["mon","tue"]'
   WHEN 2 THEN 'Mon-Fri 9-17, mon' WHEN 3 THEN '' WHEN 4 THEN 'null' ELSE e.props END AS opening_hours,
 e.value / 50 AS score, CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE CAST(e.event_id % 150 AS DOUBLE) END AS ratings,
 e.value - 100 AS lat, e.value * 2 - 200 AS lng,
 CASE WHEN e.event_id % 43 = 0 THEN 'Yes' WHEN e.event_id % 47 = 0 THEN 'maybe' ELSE 'false' END AS is_temporarily_closed,
 CASE WHEN e.event_id % 53 = 0 THEN '1' ELSE '' END AS is_permanently_closed,
 CASE WHEN e.event_id % 20 IN (0, 7) THEN '' ELSE 'P' || CAST(e.user_id AS STRING) END AS place_id,
 CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE 'C' || CAST(e.user_id % 60 AS STRING) END AS cid,
 CASE WHEN e.event_id % 4 < 2 THEN 'https://facebook.com/' || e.event_type ELSE NULL END AS facebook,
 CASE e.event_id % 5 WHEN 0 THEN 'https://instagram.com/' || e.event_type WHEN 1 THEN '  ' WHEN 2 THEN 'NaN' WHEN 3 THEN '@' || c.c_name ELSE NULL END AS instagram,
 CASE e.event_id % 7 WHEN 0 THEN 'https://book.example.com/' || CAST(e.user_id AS STRING) WHEN 1 THEN '' ELSE NULL END AS booking_link,
 CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE n.n_name || ' (' || r.r_name || ')' END AS country_name,
 CASE WHEN e.event_id % 2 = 0 THEN '' ELSE 'https://img.example.com/' || e.event_type || '.jpg' END AS main_image_url,
 CAST(e.event_id % 40 AS DOUBLE) AS images_count,
 e.ts AS collected_at
FROM {events} e LEFT JOIN {customer} c ON c.c_custkey = e.user_id LEFT JOIN {nation} n ON n.n_nationkey = c.c_nationkey LEFT JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = prepare(spark).read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def listings(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Raw listings. ``events`` may be a stream; the other tables are static.

    The given events are one split of one file, which no real export of this size
    would be, so the view deals them first.
    """
    prepare(spark)
    if events is None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        events = table(spark, sf_dir, "events").repartition(parts, "event_id")
    sources = {
        "events": events,
        **{t: table(spark, sf_dir, t) for t in ("customer", "nation", "region")},
    }
    return spark.sql(LISTING_SQL, **sources)


def typed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_types(listings(spark, sf_dir))


def cleaned_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(typed_listings(spark, sf_dir))


# Replies are derived from the requests, by a rule both engines can run: some
# fail, some are no JSON, some lack a part.
REPLY_SQL = """
SELECT key, CASE WHEN key < '2' THEN 'errored' ELSE 'succeeded' END AS status,
 CASE WHEN prompt LIKE 'Category as listed%' THEN
   CASE WHEN key < '6' THEN ' Detox Center ' WHEN key < 'a' THEN 'Support Group / Community Org (e.g. AA/NA-affiliated)'
        WHEN key < 'd' THEN 'Sober living' ELSE 'Counseling & Therapy Services' END
 WHEN prompt LIKE 'Segment: %' THEN
   CASE WHEN key < '8' THEN '{{"priority_tier": "High", "key_gaps": ["no booking link", "few photos"], "recommended_approach": "Call ' || substr(key, 1, 6) || '", "estimated_deal_rationale": "Large group"}}'
        WHEN key < 'c' THEN '{{"priority_tier": "Low", "key_gaps": []}}' ELSE 'Sorry, ' || key END
 ELSE
   CASE WHEN key < '9' THEN '{{"segment_name": "Group ' || substr(key, 1, 6) || '", "segment_description": "Alike in reviews"}}'
        WHEN key < 'b' THEN '{{"segment_name": "Only a name"}}' ELSE 'No JSON, ' || key END
 END AS text
FROM {requests}
"""


def replies_by_rule(requests: DataFrame) -> DataFrame:
    return requests.sparkSession.sql(REPLY_SQL, requests=requests.select("key", "prompt"))
