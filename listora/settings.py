"""Run settings. Every stage takes a ``Settings`` and nothing else is global."""

from __future__ import annotations

from dataclasses import dataclass

# These must stay as they are for results to agree with the
# directory format this engine reads.
PRICE_BUCKETS = ("unknown", "$", "$$", "$$$", "$$$$")
TAXONOMY = (
    "Outpatient Rehab / Treatment Center",
    "Inpatient / Residential Treatment",
    "Detox Center",
    "Methadone / Opioid Treatment Clinic",
    "Counseling & Therapy Services",
    "Sober Living / Halfway House",
    "Support Group / Community Org (e.g. AA/NA-affiliated)",
    "General Healthcare / Hospital (non-specialized)",
    "Other / Unclear",
)
FALLBACK_LABEL = "Other / Unclear"
NUMERIC_FEATURES = (
    "digital_presence_score",
    "completeness_score",
    "score",
    "ratings",
    "images_count",
)
TEXT_FEATURES = ("category", "description")


@dataclass(frozen=True)
class Settings:
    # cleaning
    min_name_length: int = 2
    default_region: str = "DE"
    drop_permanently_closed: bool = False
    timestamp_formats: tuple[str, ...] = ()
    infer_timestamp_format: bool = False  # the one format that reads most values; takes a pass over the column
    # entity resolution
    fuzzy_threshold: float = 92
    block_by: str = "zip_code"
    # enrichment
    price_buckets: tuple[str, ...] = PRICE_BUCKETS
    # category canonicalisation
    taxonomy: tuple[str, ...] = TAXONOMY
    fallback_label: str = FALLBACK_LABEL
    max_category_requests: int | None = None  # None: every category is asked
    snippet_length: int | None = None  # characters of a description in a request; None: all
    bulk_model: str = "bulk"
    reasoning_model: str = "reasoning"
    # clustering
    text_features: tuple[str, ...] = TEXT_FEATURES
    numeric_features: tuple[str, ...] = NUMERIC_FEATURES
    text_dimensions: int = 256
    text_weight: float = 0.5
    n_clusters: int = 12
    seed: int = 42
    max_iterations: int = 20
    samples_per_segment: int = 5
