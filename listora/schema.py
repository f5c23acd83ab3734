"""The directory export: its headers, and the columns that are not text."""

from __future__ import annotations

import re

# Header row of the export, in file order.
EXPORT_HEADERS = (
    "MATCH FILTERS", "NO MATCH REASONS", "NAME", "CATEGORY", "STREET ADDRESS",
    "ADDRESS", "CITY", "REGION", "ZIP CODE", "COUNTRY NAME", "COUNTRY CODE",
    "PHONE", "EMAIL", "EMAIL STATUS", "EMAIL VERIFIED AT", "WEBSITE",
    "FACEBOOK", "INSTAGRAM", "URL", "BOOKING LINK", "LAT", "LNG", "SCORE",
    "RATINGS", "IS TEMPORARILY CLOSED", "IS PERMANENTLY CLOSED", "PRICE",
    "OPENING HOURS", "POPULAR TIMES", "MAIN IMAGE URL", "IMAGES COUNT",
    "DESCRIPTION", "HAS", "OWNER ID", "PLACE ID", "CID", "ZERO X OBJECT",
    "RESULT POSITION", "TASK ID", "COLLECTED AT", "INPUT URL", "INPUT CITY",
    "INPUT REGION", "INPUT COUNTRY", "INPUT CATEGORY", "INPUT DISTRICT",
    "PARAM LANGUAGE", "PARAM DETAILS", "PARAM COLLECT CONTACTS",
    "PARAM RATINGS", "PARAM COUNTRY", "PARAM IMAGES", "PARAM MAX RESULTS",
)
# The only header whose column name is not simply its slug.
RENAMED_HEADERS = {"HAS": "has_flag_raw"}

# Columns of the export that are not plain text, and those that are trimmed.
BOOLEAN_COLUMNS = (
    "is_temporarily_closed", "is_permanently_closed", "param_collect_contacts",
    "param_ratings", "param_images",
)
NUMERIC_COLUMNS = (
    "lat", "lng", "score", "ratings", "images_count", "result_position",
    "param_max_results",
)
TIMESTAMP_COLUMN = "collected_at"
TRIMMED_COLUMNS = (
    "name", "category", "street_address", "address", "city", "region",
    "description", "email", "website",
)
ID_COLUMNS = ("place_id", "cid")

ROW_ID = "row_id"


def slug(header: str) -> str:
    return re.sub("[ -]", "_", header.strip().lower())


def column_names(headers) -> dict[str, str]:
    """Header -> column name, refusing two headers that would share a name."""
    names: dict[str, str] = {}
    owner: dict[str, str] = {}
    for header in headers:
        name = RENAMED_HEADERS.get(header, slug(header))
        if name in owner:
            raise ValueError(f"headers {owner[name]!r} and {header!r} both become {name!r}")
        owner[name] = header
        names[header] = name
    return names
