"""Presence, completeness, opening-hours, price and review features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listora.functions.hours import days_open
from listora.functions.text import present
from listora.settings import Settings

# Where each presence flag looks, what the two scores are made
# of, and the upper ends of the review tiers.
PRESENCE_SOURCES = {
    "has_website": ("website",),
    "has_email": ("email_normalized", "email"),
    "has_phone": ("phone_normalized", "phone"),
    "has_facebook": ("facebook",),
    "has_instagram": ("instagram",),
    "has_booking_link": ("booking_link",),
    "has_description": ("description",),
    "has_main_image": ("main_image_url",),
}
SOCIAL_FLAGS = ("has_facebook", "has_instagram")
DIGITAL_FLAGS = (
    "has_website", "has_email", "has_phone", "has_facebook", "has_instagram",
    "has_booking_link",
)
COMPLETENESS_COLUMNS = (
    "name", "category", "street_address", "city", "zip_code", "phone", "email",
    "website", "description", "main_image_url",
)
REVIEW_TIERS = (("none", 0), ("very_low", 5), ("low", 20), ("moderate", 100))
TOP_REVIEW_TIER = "high"
TIER_ORDER = tuple(name for name, _ in REVIEW_TIERS) + (TOP_REVIEW_TIER,)


def _total(flags) -> Column:
    return reduce(lambda a, b: a + b, (f.cast("int") for f in flags))


def presence_flags(columns) -> dict[str, Column]:
    flags = {}
    for flag, sources in PRESENCE_SOURCES.items():
        tests = [present(F.col(s)) for s in sources if s in columns]
        flags[flag] = reduce(lambda a, b: a | b, tests, F.lit(False))
    return flags


def completeness(columns) -> Column:
    used = [c for c in COMPLETENESS_COLUMNS if c in columns]
    if not used:
        return F.lit(0.0)
    return _total(present(F.col(c)) for c in used) / F.lit(float(len(used)))


def price_bucket(buckets) -> Column:
    price = F.col("price")
    return F.when(price.isin(*buckets), price).otherwise("unknown")


def review_volume_tier() -> Column:
    n = F.coalesce(F.col("ratings"), F.lit(0.0))
    tier = F.when(n <= -1, F.lit(None).cast("string"))
    for name, upper in REVIEW_TIERS:
        tier = tier.when(n <= upper, name)
    return tier.otherwise(TOP_REVIEW_TIER)


def enrich(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    have = set(df.columns)
    features = presence_flags(have)
    features["completeness_score"] = completeness(have)
    if "opening_hours" in have:
        features["days_open_per_week"] = days_open(F.col("opening_hours"))
    if "description" in have:
        features["description_length"] = F.length(F.coalesce("description", F.lit("")))
    if "price" in have:
        features["price_bucket"] = price_bucket(settings.price_buckets)
    if "ratings" in have:
        features["review_volume_tier"] = review_volume_tier()
    return df.withColumns(features).withColumns(
        {
            "social_media_count": _total(F.col(f) for f in SOCIAL_FLAGS),
            "digital_presence_score": _total(F.col(f) for f in DIGITAL_FLAGS)
            / F.lit(float(len(DIGITAL_FLAGS))),
        }
    )
