"""Prompt texts. Wording is a setting of the run, not part of any result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CATEGORY_SYSTEM = (
    "Assign a business-directory category to one label of a closed list. "
    "Reply with that label only, spelled as in the list."
)
SEGMENT_SYSTEM = (
    "Name a group of businesses from its statistics and a few members. "
    'Reply with a JSON object holding "segment_name" and "segment_description".'
)
BRIEF_SYSTEM = (
    "Advise a sales team on one segment of a business directory. Reply with a "
    'JSON object holding "priority_tier", "key_gaps" (a list), '
    '"recommended_approach" and "estimated_deal_rationale".'
)


def category_prompt(category: Column, snippet: Column, taxonomy) -> Column:
    options = "".join(f"\n- {label}" for label in taxonomy)
    about = F.when(snippet != "", F.concat(F.lit("\nDescription: "), snippet)).otherwise("")
    return F.concat(
        F.lit("Category as listed: "), category, about,
        F.lit(f"\n\nLabels:{options}\n\nWhich label fits best?"),
    )


def stat_lines(stats: dict[str, Column]) -> Column:
    return F.concat_ws(
        "\n",
        *(
            F.concat(F.lit(f"- {name}: "), F.coalesce(value.cast("string"), F.lit("none")))
            for name, value in stats.items()
        ),
    )


def segment_prompt(cluster: Column, stats: Column, members: Column) -> Column:
    return F.concat(
        F.lit("Segment "), cluster.cast("string"), F.lit("\n"), stats,
        F.lit("\n\nMembers:\n"), members, F.lit("\n\nName and describe the segment."),
    )


def brief_prompt(name: Column, description: Column, stats: Column) -> Column:
    return F.concat(
        F.lit("Segment: "), name, F.lit("\nAbout: "), description, F.lit("\n"), stats,
        F.lit("\n\nWrite the brief."),
    )
