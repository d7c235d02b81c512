"""ODS -> star schema: date, client, post-type and location dimensions; post, insight and fan
demographics facts.

Scale notes
-----------
- ``dim_date`` is a gap-free day series keyed by ``days since start + 1``. The facts compute
  that key from their own date (``operators.date_key``) instead of joining the dimension: the
  left join of the load becomes "NULL outside the series", the inner join becomes a filter.
  No broadcast, no join, same result.
- Label dimensions get dense ids in label order (``operators.sequential_ids``), so ids are
  reproducible run to run (the database's SERIAL ids are not). Facts join the written
  dimension by label; Spark broadcasts it by its file size, else it is a shuffle join.
- The demographics fact unions its three sources first and joins the location dimension once
  on (type, label) instead of three times.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_fields, to_int
from ..operators import continued_ids, date_key, dense_ids, sequential_ids
from .ods import CLIENT_COLUMNS, FAN_KINDS, INSIGHT_COUNTERS, VIDEO_FIELDS, video_columns

# Fixed value (must equal the reference): first day of the date dimension.
DATE_START = dt.date(2010, 1, 1)

# Click-map keys (with blanks) -> fact columns.
CLICK_FIELDS = (("photo view", "photo_view"), ("link clicks", "link_clicks"), ("other clicks", "other_clicks"))

FACT_POST_COLUMNS = ("post_id", "client_id", "date_id", "post_type_id", "social_type", "likes", "comments", "shares",
                     "views", "clicks", "reactions", "reach", "reach_organic", "reach_paid", *VIDEO_FIELDS,
                     "photo_view", "link_clicks", "other_clicks", "is_real")

DATE_ROWS_PER_PARTITION = 1_000_000


def today_utc() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def _date_row(d: Column, start: dt.date) -> list[Column]:
    return [
        date_key(d, start).cast("int").alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.weekofyear(d).alias("week"),
        F.quarter(d).alias("quarter"),
    ]


def dim_date(spark: SparkSession, start: dt.date = DATE_START, end: dt.date | None = None) -> DataFrame:
    """One row per day ``start..end`` (both included; ``end`` defaults to today, UTC) with
    date_id = day number from 1, ISO week, calendar year/month/day/quarter."""
    end = end or today_utc()
    n = max((end - start).days + 1, 0)
    days = spark.range(0, n, 1, max(1, n // DATE_ROWS_PER_PARTITION))
    return days.select(*_date_row(F.date_add(F.lit(start), F.col("id").cast("int")), start))


def dim_date_through(days: DataFrame, start: dt.date = DATE_START) -> DataFrame:
    """The date dimension from ``start`` through the last day in ``days`` (column ``d``), lazily:
    one aggregate row expanded into the day series (bounded by the number of days spanned)."""
    last = days.agg(F.max("d").alias("last_day"))
    series = F.when(F.col("last_day") >= F.lit(start),
                    F.sequence(F.lit(start), F.col("last_day"), F.expr("INTERVAL 1 DAY")))
    return last.select(F.explode(series).alias("d")).select(*_date_row(F.col("d"), start))


def dim_client(clients_clean: DataFrame) -> DataFrame:
    """The cleaned client table. It is unique on client_id already (first-wins load), so the
    DISTINCT and the replace-on-conflict of the load change nothing; ``quality.duplicate_keys``
    states that invariant as a check instead of paying a shuffle for it."""
    return clients_clean.select(*CLIENT_COLUMNS)


LOCATION_KEY = ["location_type", "location_label"]


def post_type_labels(posts_clean: DataFrame) -> DataFrame:
    return posts_clean.where(F.col("post_type").isNotNull()).select(F.col("post_type").alias("label")).distinct()


def location_labels(fan_rows: DataFrame) -> DataFrame:
    return fan_rows.select(*LOCATION_KEY).distinct()


def dim_post_type(posts_clean: DataFrame) -> DataFrame:
    """Distinct non-NULL post type labels with dense ids in label order."""
    return sequential_ids(post_type_labels(posts_clean), ["label"], "post_type_id").select("post_type_id", "label")


def dim_location(fan_rows: DataFrame) -> DataFrame:
    """Distinct (type, label) over the fan entries of all kinds (``ods.fan_entries``; a NULL
    label is one value, as in UNION) with dense ids in (type, label) order."""
    return sequential_ids(location_labels(fan_rows), LOCATION_KEY, "location_id").select("location_id", *LOCATION_KEY)


def registered(labels: DataFrame, key: Sequence[str], id_col: str, known: DataFrame | None) -> DataFrame:
    """Registry of a label dimension after this run (``operators.continued_ids``), with ``current``: whether the run holds the label.
    The dimension is the rows that are current."""
    key = list(key)
    if known is None:
        return sequential_ids(labels.select(*key), key, id_col).select(id_col, *key, F.lit(True).alias("current"))
    now = labels.select(*[F.col(c).alias(f"__{c}") for c in key], F.lit(True).alias("__now"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key])
    return (continued_ids(labels, key, id_col, known).join(now, same, "left")
            .select(id_col, *key, F.coalesce("__now", F.lit(False)).alias("current")))


def click_columns(click_map: Column) -> dict[str, Column]:
    """The click map text split into photo_view, link_clicks, other_clicks (INT), one parse."""
    clicks = json_fields(click_map, [k for k, _ in CLICK_FIELDS])
    return {name: to_int(clicks[key]).alias(name) for key, name in CLICK_FIELDS}


def fact_posts(posts_clean: DataFrame, post_types: DataFrame, video: DataFrame | None = None,
               start: dt.date = DATE_START, end: dt.date | None = None) -> DataFrame:
    """Posts with date, post-type and video keys/counters and the click map split in three.

    The post-type dimension is joined by label. Video counters:
    with ``video`` (the video table) a left join on post_id; with ``video=None`` the posts must
    carry the raw payload (``ods.ods_posts(keep_payload=True)``) and the counters are parsed
    from it in the same pass. Both give the same rows, since the video table is a projection
    of the same staged post; the second needs no shuffle of two post-sized tables."""
    types = post_types.select(F.col("label").alias("__label"), "post_type_id")
    joined = posts_clean.join(types, F.col("post_type") == F.col("__label"), "left")
    cols = {"date_id": date_key(F.to_date("creation_time"), start, end).cast("int").alias("date_id")}
    if video is None:
        cols.update(video_columns(F.col("data")))
    else:
        joined = joined.join(video.select("post_id", *VIDEO_FIELDS), "post_id", "left")
    cols.update(click_columns(F.col("post_clicks_by_type")))
    return joined.select(*[cols.get(c, F.col(c)) for c in FACT_POST_COLUMNS])


def fact_insights(insights_clean: DataFrame, start: dt.date = DATE_START, end: dt.date | None = None) -> DataFrame:
    """Insights with their date key (NULL when the day is outside the date dimension;
    ``end=None``: the dimension reaches the last day of the data)."""
    return insights_clean.select("insight_id", "client_id",
                                 date_key(F.col("insight_date"), start, end).cast("int").alias("date_id"),
                                 *INSIGHT_COUNTERS)


def fact_fan_demographics(fan_rows: DataFrame, locations: DataFrame, start: dt.date = DATE_START,
                          end: dt.date | None = None, with_fact_id: bool = True) -> DataFrame:
    """One row per fan entry (``ods.fan_entries``, all kinds in one table) whose (type, label)
    is a location and whose day is in the date dimension (both inner joins in the load: other
    rows are dropped). One join on (type, label) serves all three kinds. ``fact_id`` numbers the rows
    1..n as the load's three statements do, country, city, then locale, each by insight and location."""
    rows = fan_rows.join(locations, LOCATION_KEY, "inner")
    date_id = date_key(F.col("insight_date"), start, end).cast("int")
    cols = ["insight_id", "client_id", "date_id", "location_id", "nb_fans"]
    kind = F.array_position(F.array(*map(F.lit, FAN_KINDS)), F.col("location_type")).cast("int")
    out = rows.select("insight_id", "client_id", date_id.alias("date_id"), "location_id", "nb_fans", kind.alias("__kind")) \
              .where(F.col("date_id").isNotNull())
    if not with_fact_id:
        return out.select(*cols)
    return dense_ids(out, ["__kind", "insight_id", "location_id"], "fact_id").select("fact_id", *cols)
