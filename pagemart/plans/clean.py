"""Cleaning pass over the ODS tables, as projections.

The load rewrites whole tables in place with UPDATE statements; here each rewrite is a column
expression applied on top of the ODS job, so Catalyst fuses it into the same stage (no second
pass over the data). The order of the rewrites is kept: the ``storie`` rename runs before
trimming, so ``' storie '`` ends as ``storie``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null, clean_post_type, zero_to_null
from .ods import INSIGHT_COUNTERS


def clean_clients(ods_clients: DataFrame) -> DataFrame:
    """name, type, picture: trimmed, blank -> NULL."""
    return ods_clients.withColumns({c: blank_to_null(F.col(c)) for c in ("name", "type", "picture")})


def clean_posts(ods_posts: DataFrame) -> DataFrame:
    """post_type: ``storie`` -> ``Story``, then message, post_type, is_real trimmed, blank -> NULL."""
    return ods_posts.withColumns({
        "message": blank_to_null(F.col("message")),
        "post_type": clean_post_type(F.col("post_type")),
        "is_real": blank_to_null(F.col("is_real")),
    })


def clean_insights(ods_insights: DataFrame) -> DataFrame:
    """The 13 counters: 0 -> NULL (post counters are left as they are)."""
    return ods_insights.withColumns({c: zero_to_null(F.col(c)) for c in INSIGHT_COUNTERS})
