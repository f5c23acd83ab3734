"""Rule-based cleaning: one pass of column expressions, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listora.functions.phones import to_e164
from listora.functions.text import not_blank, title_words, trim_ws
from listora.settings import Settings

# What counts as an e-mail address, and the allowed ranges.
EMAIL_PATTERN = r"(?U)^[^@\s]+@[^@\s]+\.[^@\s]+$"
RANGES = {"score": (0, 5), "lat": (-90, 90), "lng": (-180, 180)}


def usable_name(min_length: int) -> Column:
    """Also false for a missing name, whose length is null."""
    return F.length("name") >= min_length


def email_normalized(c: Column) -> Column:
    address = F.lower(trim_ws(c))
    return F.when(address.rlike(EMAIL_PATTERN), address)


def email_syntax_valid(c: Column) -> Column:
    return email_normalized(c).isNotNull()


def category_normalized(c: Column) -> Column:
    return F.when(not_blank(c), title_words(trim_ws(c)))


def is_active(columns) -> Column:
    """Neither closed for good nor for now; an absent column means not closed."""
    closed = [
        F.coalesce(F.col(name), F.lit(False))
        for name in ("is_permanently_closed", "is_temporarily_closed")
        if name in columns
    ]
    active = F.lit(True)
    for flag in closed:
        active = active & ~flag
    return active


def clamped(name: str) -> Column:
    low, high = RANGES[name]
    return F.when(F.col(name).between(low, high), F.col(name))


def clean(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    have = set(df.columns)
    if "name" in have:
        df = df.filter(usable_name(settings.min_name_length))
    if settings.drop_permanently_closed and "is_permanently_closed" in have:
        df = df.filter(~F.coalesce(F.col("is_permanently_closed"), F.lit(False)))

    added: dict[str, Column] = {}
    if "phone" in have:
        added["phone_normalized"] = to_e164(F.col("phone"), settings.default_region)
    if "email" in have:
        added["email_normalized"] = email_normalized(F.col("email"))
        added["email_syntax_valid"] = email_syntax_valid(F.col("email"))
    if "category" in have:
        added["category_normalized"] = category_normalized(F.col("category"))
    added["is_active"] = is_active(have)
    for name in RANGES:
        if name in have:
            added[name] = clamped(name)
    return df.withColumns(added)
