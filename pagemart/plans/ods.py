"""Staging -> ODS jobs: one function per ODS table, each a pure DataFrame transform.

Outputs follow the ODS DDL column order and types. These are the tables *as loaded*; the
cleaning pass (``plans.clean``) is a projection on top, fused by Catalyst into the same stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (has_json, initcap_words, int_to_bool, json_fields, locale_braces, platform_ok,
                         post_type, reactions_total, simple_braces, to_int)
from ..functions.text import blank_to_null
from ..operators import first_wins, json_members
from ..operators.explode import first_heads

CLIENT_COLUMNS = ("client_id", "name", "managed", "social_type", "actif", "type", "picture")

POST_COLUMNS = ("post_id", "client_id", "social_type", "post_type", "creation_time", "message", "comments",
                "likes", "shares", "views", "clicks", "reactions", "reach", "reach_organic", "reach_paid",
                "is_real", "post_clicks_by_type")

INSIGHT_COUNTERS = ("page_fans", "page_fan_adds", "page_fan_removes", "page_engaged_users",
                    "page_impressions_unique", "page_impressions_organic_unique_v2",
                    "page_impressions_paid_unique", "page_post_engagements", "page_fans_online_per_day",
                    "page_impressions", "page_impressions_organic_v2", "page_impressions_paid", "page_follows")
INSIGHT_COLUMNS = ("insight_id", "client_id", "insight_date", *INSIGHT_COUNTERS,
                   "page_fans_country", "page_fans_city", "page_fans_locale")

# fan table kind -> (insight text column, label column, brace repair)
FAN_KINDS = {
    "country": ("page_fans_country", "country", simple_braces),
    "city": ("page_fans_city", "city", simple_braces),
    "locale": ("page_fans_locale", "locale", locale_braces),
}

VIDEO_FIELDS = ("total_video_views", "total_video_views_paid", "total_video_views_organic",
                "total_video_views_autoplayed", "total_video_views_clicked_to_play")


def _client_rows(stg: DataFrame) -> DataFrame:
    return stg.where(platform_ok(F.col("social_type"))).select(
        F.col("id").alias("client_id"),
        initcap_words(F.col("name")).alias("name"),
        int_to_bool(F.col("managed")).alias("managed"),
        "social_type",
        int_to_bool(F.col("actif")).alias("actif"),
        "type",
        "picture",
    )


def ods_clients(stg_clients: DataFrame, stg_unmanaged: DataFrame) -> DataFrame:
    """Both client lists, platform-filtered, title-cased; a page in both lists keeps its managed
    row (the managed branch comes first in the load, first row per id wins)."""
    both = (_client_rows(stg_clients).withColumn("__list", F.lit(0))
            .unionByName(_client_rows(stg_unmanaged).withColumn("__list", F.lit(1))))
    return first_wins(both, ["client_id"], ["__list"]).select(*CLIENT_COLUMNS)


def eligible_pages(stg_clients: DataFrame, stg_unmanaged: DataFrame) -> DataFrame:
    """One row per page id kept by the platform filter in either list, with a flag per list.
    Computed once and shared by the post and insight jobs."""
    m = stg_clients.where(platform_ok(F.col("social_type"))).select(
        F.col("id").alias("page_id"), F.lit(True).alias("in_managed"), F.lit(False).alias("in_unmanaged"))
    u = stg_unmanaged.where(platform_ok(F.col("social_type"))).select(
        F.col("id").alias("page_id"), F.lit(False).alias("in_managed"), F.lit(True).alias("in_unmanaged"))
    return (m.unionByName(u).where(F.col("page_id").isNotNull())
             .groupBy("page_id").agg(F.max("in_managed").alias("in_managed"),
                                     F.max("in_unmanaged").alias("in_unmanaged")))


def ods_posts(stg_posts: DataFrame, pages: DataFrame, strict_deleted: bool = False, carry_clicks: bool = False,
              keep_payload: bool = False) -> DataFrame:
    """Posts of eligible pages with derived type and reaction total.

    Literal filter of the load: ``is_deleted = 0 AND page in managed OR page in unmanaged`` --
    AND binds first, so deleted posts of unmanaged pages are kept. ``strict_deleted=True``
    applies ``is_deleted = 0`` to both lists. The load does not select the click map, so
    ``post_clicks_by_type`` is NULL unless ``carry_clicks=True``.

    ``pages`` has one row per page. Spark broadcasts it when its files are below the session's byte
    bound, else it is a shuffle join (adaptive execution splits a hot page's partition). ``keep_payload=True`` adds
    the raw ``data`` payload as an 18th column so the post fact can take the video counters from
    the same row instead of joining the video table back on post_id."""
    joined = stg_posts.join(pages, "page_id", "left")
    m = F.coalesce(F.col("in_managed"), F.lit(False))
    u = F.coalesce(F.col("in_unmanaged"), F.lit(False))
    live = F.col("is_deleted") == 0
    keep = (live & (m | u)) if strict_deleted else ((live & m) | u)
    clicks = F.col("post_clicks_by_type") if carry_clicks else F.lit(None).cast("string")
    return joined.where(keep).select(
        F.col("id").alias("post_id"),
        F.col("page_id").alias("client_id"),
        "social_type",
        post_type(F.col("type"), F.col("url"), F.col("status_type")).alias("post_type"),
        "creation_time", "message", "comments", "likes", "shares", "views", "clicks",
        reactions_total().alias("reactions"),
        "reach", "reach_organic", "reach_paid", "is_real",
        clicks.alias("post_clicks_by_type"),
        *([F.col("data")] if keep_payload else []),
    )


def ods_insights(stg_insights: DataFrame, pages: DataFrame) -> DataFrame:
    """Insights of eligible **managed** pages only (unmanaged insights are staged but dropped)."""
    managed = pages.where("in_managed").select("page_id")
    return stg_insights.join(managed, "page_id", "left_semi").select(
        F.col("id").alias("insight_id"),
        F.col("page_id").alias("client_id"),
        F.col("day").alias("insight_date"),
        *INSIGHT_COUNTERS,
        "page_fans_country", "page_fans_city", "page_fans_locale",
    )


def fan_entries(insights: DataFrame, kinds=tuple(FAN_KINDS), clean: bool = False, strict: bool = False,
                with_text: bool = False) -> DataFrame:
    """Members of the fan maps of every insight, all ``kinds`` in one pass over the insights:
    (location_type, insight_id, client_id, insight_date, location_label, nb_fans).

    Per kind: texts that carry no JSON (NULL, '', '0', '[]', '{}') are skipped before parsing,
    the rest are brace-repaired and exploded, and a repeated key keeps its first value.
    ``clean=True`` also applies the cleaning pass: labels trimmed, blank labels dropped, first
    wins again when two labels meet after trimming. Both are decided inside the row (no
    shuffle). ``with_text=True`` adds the member position ``pos`` and the raw value text
    ``value_text`` (for the quality checks)."""
    key_fn = blank_to_null if clean else None
    keep = ["insight_id", "client_id", "insight_date"]
    # stage 1: parse and sort each map once (a column); stage 2 reads it (see first_heads)
    sorted_maps = insights.select(*keep, *[
        F.when(has_json(F.col(FAN_KINDS[kind][0])),
               json_members(FAN_KINDS[kind][2](F.col(FAN_KINDS[kind][0])), key_fn, clean)).alias(f"__m_{kind}")
        for kind in kinds])
    per_kind = F.array(*[F.struct(F.lit(kind).alias("t"), first_heads(F.col(f"__m_{kind}")).alias("m"))
                         for kind in kinds])
    by_kind = sorted_maps.select(*keep, F.explode(per_kind).alias("__kind"))
    members = by_kind.select(*keep, F.col("__kind.t").alias("location_type"), F.explode("__kind.m").alias("__m"))
    extra = [F.col("__m.p").alias("pos"), F.col("__m.v").alias("value_text")] if with_text else []
    return members.select("location_type", *keep, F.col("__m.k").alias("location_label"),
                          to_int(F.col("__m.v"), strict).alias("nb_fans"), *extra)


def ods_fans(insights: DataFrame, kind: str, clean: bool = False, strict: bool = False) -> DataFrame:
    """The ODS fan table of one kind (country / city / locale): insight_id, client_id,
    insight_date, <kind>, nb_fans. See ``fan_entries``."""
    label = FAN_KINDS[kind][1]
    return fan_entries(insights, (kind,), clean, strict).select(
        "insight_id", "client_id", "insight_date", F.col("location_label").alias(label), "nb_fans")


def video_columns(payload_text, strict: bool = False) -> dict:
    """The five video counters of a post payload text (``data.data.*``) as INT. A payload
    without JSON (see ``has_json``: NULL, '', '0', '[]', '{}') gives NULLs by itself, so no
    guard is added: a CASE around each counter would hide the shared parse from Spark's
    common-subexpression elimination and parse the payload five times per row instead of once."""
    payload = json_fields(payload_text, VIDEO_FIELDS, under="data")
    return {f: to_int(payload[f], strict).alias(f) for f in VIDEO_FIELDS}


def ods_data_video(stg_posts: DataFrame, strict: bool = False, with_load_time: bool = True) -> DataFrame:
    """Video counters from the post payload ``data.data.*`` as INT, for every staged post whose
    payload text carries JSON (no page or delete filter, as in the load)."""
    src = stg_posts.where(has_json(F.col("data")))
    cols = [F.col("id").alias("post_id"), *video_columns(F.col("data"), strict).values()]
    if with_load_time:
        cols.append(F.current_timestamp().alias("created_at"))
    return src.select(*cols)
