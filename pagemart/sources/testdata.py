"""Adapters that shape the generic test tables into the staging tables the jobs read.

The test tables hold no NULLs, blanks or broken JSON; these views create them deterministically
from the row keys, so every edge case of the ODS rules is exercised on whole tables. The same
views exist as SQL text in ``pagemart.oracle`` for the DuckDB oracle.

Mapping: customer -> pages (even keys: managed list, odd keys and multiples of 10: unmanaged
list, so both lists together cover every customer and overlap on multiples of 10);
orders -> posts (o_custkey is the page); events -> daily insights (user_id is the page).
Only the staging columns the jobs use are produced; the rest of the staging schema is unused.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _case(expr: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(expr == k, F.lit(v)) if out is None else out.when(expr == k, F.lit(v)))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


# Market segment -> platform of a managed page (others: NULL platform).
SEGMENT_PLATFORM = {"HOUSEHOLD": "facebook", "BUILDING": "Instagram", "FURNITURE": "YouTube", "MACHINERY": "ytb"}


def stg_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.where(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").cast("int").alias("id"),
        F.concat(F.lower("c_mktsegment"), F.lit("_"), "c_name", F.lit("-PAGE")).alias("name"),
        _case(F.col("c_mktsegment"), SEGMENT_PLATFORM, F.lit(None).cast("string")).alias("social_type"),
        F.when(F.col("c_nationkey") % 5 == 0, F.lit("  ")).otherwise(F.lit(" page ")).alias("type"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit("")).otherwise(
            F.concat(F.lit("http://p/"), _s(F.col("c_custkey")))).alias("picture"),
        (F.col("c_nationkey") % 2).cast("int").alias("actif"),
        F.lit(1).alias("managed"),
    )


def stg_unmanaged_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.where((F.col("c_custkey") % 2 == 1) | (F.col("c_custkey") % 10 == 0)).select(
        F.col("c_custkey").cast("int").alias("id"),
        F.upper("c_name").alias("name"),
        F.when(F.col("c_nationkey") % 4 == 0, F.lit("TikTok")).otherwise(F.lit("facebook")).alias("social_type"),
        F.lit("shop").alias("type"),
        F.lit("").alias("picture"),
        F.lit(1).alias("actif"),
        F.lit(0).alias("managed"),
    )


# Order priority -> raw post type.
PRIORITY_TYPE = {"1-URGENT": "storie", "2-HIGH": " Photo", "3-MEDIUM": ""}
# Order key mod 8 -> status type (4 and unlisted: NULL).
STATUS_BY_MOD8 = {0: "added_photos", 1: "added_video", 2: "mobile_status_update", 3: "shared_story",
                  5: "storie_video", 6: "", 7: "other"}


def stg_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")

    def i(c: Column) -> Column:
        return c.cast("int")

    null_int = F.lit(None).cast("int")
    video = F.concat(F.lit('{"data":{"total_video_views":'), _s(ck),
                     F.lit(',"total_video_views_paid":null,"total_video_views_organic":"7","total_video_views_autoplayed":'),
                     F.when(k % 31 == 2, F.lit('"n/a"')).otherwise(_s(k % 6)),
                     F.lit(',"total_video_views_clicked_to_play":'), _s(k % 3), F.lit("}}"))
    return o.select(
        k.alias("id"),
        i(ck).alias("page_id"),
        F.when(ck % 2 == 0, F.lit("facebook")).otherwise(F.lit("instagram")).alias("social_type"),
        F.col("o_orderdate").alias("creation_time"),
        F.when(k % 4 == 0, F.concat(F.lit("/reel/"), _s(k))).when(k % 4 == 1, F.lit("/p/x")).alias("url"),
        _case(F.col("o_orderpriority"), PRIORITY_TYPE, F.lit(None).cast("string")).alias("type"),
        _case(k % 8, STATUS_BY_MOD8, F.lit(None).cast("string")).alias("status_type"),
        F.when(k % 6 == 0, F.lit("   ")).when(k % 37 == 1, F.concat(F.lit("cut"), F.char(F.lit(0)), F.lit("here")))
         .otherwise(F.concat(F.lit("  msg "), F.col("o_orderpriority"))).alias("message"),
        i(k % 11).alias("likes"),
        F.when(k % 3 == 0, null_int).otherwise(i(k % 5)).alias("wow"),
        F.when(k % 2 == 0, null_int).otherwise(F.lit(1)).alias("sad"),
        null_int.alias("haha"),
        F.lit(0).alias("angry"),
        i(k % 4).alias("love"),
        null_int.alias("thankful"),
        i(k % 13).alias("comments"),
        i(k % 17).alias("shares"),
        i(k % 101).alias("views"),
        i(k % 19).alias("clicks"),
        i(ck % 97).alias("reach"),
        i(ck % 53).alias("reach_organic"),
        i(ck % 44).alias("reach_paid"),
        F.when(k % 5 == 0, F.lit(" ")).otherwise(F.lit("1")).alias("is_real"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).when(k % 29 == 0, null_int).otherwise(F.lit(0)).alias("is_deleted"),
        F.when(k % 41 == 3, F.lit('{"data":{"total_video_views":1')).when(k % 5 == 0, F.lit(None).cast("string"))
         .when(k % 5 == 1, F.lit("[]")).when(k % 5 == 2, video)
         .when(k % 5 == 3, F.lit('{"other":1}')).otherwise(F.lit("")).alias("data"),
        F.when(k % 3 == 0, F.concat(F.lit('{"photo view":'), _s(k % 9), F.lit(',"link clicks":2,"other clicks":"'), _s(k % 7), F.when(k % 2 == 0, F.lit("x")).otherwise(F.lit("")), F.lit('"}'))).alias("post_clicks_by_type"),
    )


def stg_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    ev, uid, props = F.col("event_id"), F.col("user_id"), F.col("props")
    plen = F.length(props)

    def i(c: Column) -> Column:
        return c.cast("int")

    def b(c: Column) -> Column:
        return c.cast("bigint")

    s_null = F.lit(None).cast("string")
    country = (F.when(ev % 43 == 1, F.lit('{"TN":1}{"FR":2}')).when(ev % 7 == 0, props).when(ev % 7 == 1, F.substr(props, F.lit(2), plen - 2))
                .when(ev % 7 == 2, F.lit("")).when(ev % 7 == 3, F.lit("{}")).when(ev % 7 == 4, s_null)
                .when(ev % 7 == 5, F.lit("[]"))
                .otherwise(F.concat(F.lit('{"TN":'), _s(uid), F.lit(',"FR":3,"TN":9}'))))
    city = (F.when(ev % 47 == 2, F.lit('{"Sfax":"many"," Tunis":4,"Tunis ":5,"  ":1,"Gabes":"6"}')).when(ev % 4 == 0, F.concat(F.lit(' {" Tunis ":'), _s(ev % 50), F.lit(',"Sfax":2}')))
             .when(ev % 4 == 1, F.lit('"Paris, FR":5')).when(ev % 4 == 2, F.lit("0")).otherwise(F.lit("   ")))
    locale = (F.when(ev % 53 == 3, F.lit('{"fr_FR":')).when(ev % 6 == 0, F.concat(props, F.lit("}"))).when(ev % 6 == 1, F.substr(props, F.lit(1), plen - 1))
               .when(ev % 6 == 2, F.substr(props, F.lit(2))).when(ev % 6 == 3, F.lit("  "))
               .when(ev % 6 == 4, props).otherwise(F.substr(props, F.lit(2), plen - 2)))
    return e.select(
        ev.alias("id"),
        i(uid).alias("page_id"),
        F.col("ts").cast("date").alias("day"),
        b(ev % 4).alias("page_fans"),
        i(ev % 3).alias("page_fan_adds"),
        i(ev % 2).alias("page_fan_removes"),
        i(ev % 5).alias("page_engaged_users"),
        i(ev % 23).alias("page_impressions_unique"),
        i(ev % 7).alias("page_impressions_organic_unique_v2"),
        F.lit(0).alias("page_impressions_paid_unique"),
        i(ev % 9).alias("page_post_engagements"),
        F.lit(None).cast("int").alias("page_fans_online_per_day"),
        i(ev % 31).alias("page_impressions"),
        i(ev % 29).alias("page_impressions_organic_v2"),
        i(ev % 8).alias("page_impressions_paid"),
        b(uid % 6).alias("page_follows"),
        country.alias("page_fans_country"),
        city.alias("page_fans_city"),
        locale.alias("page_fans_locale"),
    )


class Staging:
    """The four staging tables of one test scale, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def clients(self) -> DataFrame:
        return stg_clients(self.spark, self.sf_dir)

    @cached_property
    def unmanaged_clients(self) -> DataFrame:
        return stg_unmanaged_clients(self.spark, self.sf_dir)

    @cached_property
    def posts(self) -> DataFrame:
        return stg_posts(self.spark, self.sf_dir)

    @cached_property
    def insights(self) -> DataFrame:
        return stg_insights(self.spark, self.sf_dir)
