"""Staging table columns and types (the target DDL), in DDL order."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

_CLIENT = """id int, name string, social_id string, social_type string, type string, state string, picture string,
cover string, related_instagram_id string, created_at timestamp_ntz, updated_at timestamp_ntz, owner_id int,
local_media string, actif int, managed int"""

_POST = """id bigint, page_id int, social_id string, social_type string, creation_time timestamp_ntz, url string,
type string, status_type string, message string, story string, picture string, profile_cover string, reactions int,
comments int, shares int, views int, views_organic int, views_paid int, reach int, reach_organic int, reach_paid int,
likes int, wow int, sad int, haha int, angry int, none int, love int, thankful int, is_deleted int,
created_at timestamp_ntz, updated_at timestamp_ntz, data string, local_media string, clicks int,
post_clicks_by_type string, saved int, is_real string, comments_ad int, views_ad int, reach_ad int, likes_ad int,
saved_ad int, shares_ad int, tag string, reactions_new string, score_new string, commentaires string"""

_INSIGHT = """id bigint, page_id int, day date, page_fans bigint, page_fan_adds int, page_fan_removes int,
page_impressions_unique int, page_impressions_organic_unique_v2 int, page_impressions_paid_unique int,
page_fans_online_per_day int, page_engaged_users int, page_fans_online string, page_fans_country string,
page_fans_city string, page_fans_locale string, page_fans_gender_age string, data string, created_at timestamp_ntz,
updated_at timestamp_ntz, page_fans_seniority string, page_fans_industry string, page_fans_job_function string,
page_fan_adds_by_paid_non_paid_unique string, page_post_engagements int, page_impressions int,
page_impressions_paid int, page_impressions_organic_v2 int, page_follows bigint, page_impressions_unique_28 bigint,
page_impressions_unique_week bigint"""


def _parse(ddl: str) -> list[tuple[str, str]]:
    cols = []
    for part in " ".join(ddl.split()).split(","):
        name, typ = part.strip().split(" ")
        cols.append((name, typ))
    return cols


STG_CLIENT_COLUMNS = _parse(_CLIENT)
STG_POST_COLUMNS = _parse(_POST)
STG_INSIGHT_COLUMNS = _parse(_INSIGHT)


def all_strings(cols: list[tuple[str, str]]) -> StructType:
    """The columns as a struct of strings (how a JSON record is read before typing)."""
    return StructType([StructField(n, StringType()) for n, _ in cols])
