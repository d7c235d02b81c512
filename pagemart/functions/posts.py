"""Post-level derivations: post type label and reaction total."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null

# Fixed values (must equal the reference).
# Labels produced when the source gives no post type.
REELS, PHOTO, VIDEO, STORY, TEXT = "Reels", "Photo", "Video", "Story", "Texte"
REEL_URL_PREFIX = "/reel/"
# status_type -> label, checked in this order.
STATUS_LABELS = (
    ("added_photos", PHOTO),
    ("added_video", VIDEO),
    ("mobile_status_update", REELS),
)
STORY_STATUSES = ("shared_story", "storie_photo", "storie_video")
# The one raw type value renamed by the cleaning pass.
RAW_STORY_TYPE = "storie"

# The seven counters summed into ``reactions``. The source ``reactions`` and
# ``none`` columns are not part of the sum.
REACTION_COLUMNS = ("likes", "wow", "sad", "haha", "angry", "love", "thankful")


def post_type(type_: Column, url: Column, status_type: Column) -> Column:
    """Label as the ODS insert computes it: a non-empty source type wins as is (untrimmed, so
    ``' storie '`` stays), else it is derived from the URL and the status type."""
    derived = (F.when(url.startswith(REEL_URL_PREFIX), F.lit(REELS)))
    for status, label in STATUS_LABELS:
        derived = derived.when(status_type == status, F.lit(label))
    derived = (derived.when(status_type.isin(*STORY_STATUSES), F.lit(STORY))
                      .when(status_type.isNull() | (status_type == ""), F.lit(TEXT)))
    return F.coalesce(F.nullif(type_, F.lit("")), derived)


def clean_post_type(label: Column) -> Column:
    """Cleaning pass on the stored label: exact ``storie`` becomes ``Story`` first, then the
    label is trimmed and blanks become NULL (so ``' storie '`` ends as ``storie``)."""
    renamed = F.when(label == RAW_STORY_TYPE, F.lit(STORY)).otherwise(label)
    return blank_to_null(renamed)


def reactions_total(*counters: Column) -> Column:
    """Null-safe integer sum; a missing counter counts as 0."""
    cols = counters or tuple(F.col(c) for c in REACTION_COLUMNS)
    return reduce(add, [F.coalesce(c, F.lit(0)) for c in cols]).cast("int")
