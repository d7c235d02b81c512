"""Row predicates shared by the ODS jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): platforms whose pages never reach the ODS layer,
# compared after lower-casing.
EXCLUDED_PLATFORMS = ("ytb", "youtube", "tiktok", "linkedin")

# Texts that mean "no JSON payload" in the JSON-bearing columns.
NO_JSON_TEXTS = ("0", "[]", "{}")


def platform_ok(social_type: Column) -> Column:
    """True for platforms that are kept. NULL platform gives NULL, which a filter drops
    (SQL three-valued ``NOT IN``)."""
    return ~F.lower(social_type).isin(*EXCLUDED_PLATFORMS)


def has_json(c: Column) -> Column:
    """Text that may carry a JSON payload: not NULL, not empty, not one of the empty markers."""
    return c.isNotNull() & ~c.isin(*NO_JSON_TEXTS) & (c != F.lit(""))
