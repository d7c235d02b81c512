"""ODS / DW jobs on literal rows: quirks of the load kept as decided in SURVEY section 7.3."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pagemart.plans import clean, dw, ods, rejects

CLIENT = "id int, name string, social_type string, type string, picture string, actif int, managed int"
POST = ("id bigint, page_id int, social_type string, creation_time timestamp_ntz, url string, type string, "
        "status_type string, message string, likes int, wow int, sad int, haha int, angry int, love int, "
        "thankful int, comments int, shares int, views int, clicks int, reach int, reach_organic int, "
        "reach_paid int, is_real string, is_deleted int, data string, post_clicks_by_type string")


def post(id_, page, deleted):
    return (id_, page, "facebook", dt.datetime(2024, 1, 1), None, "Photo", None, "m", 1, None, None, None, 0, 2,
            None, 1, 1, 1, 1, 1, 1, 1, "1", deleted, None, None)


def test_deleted_posts_and_precedence(spark):
    managed = spark.createDataFrame([(1, "a", "facebook", "x", "", 1, 1)], CLIENT)
    unmanaged = spark.createDataFrame([(2, "b", "facebook", "x", "", 1, 0)], CLIENT)
    posts = spark.createDataFrame([post(10, 1, 1), post(11, 2, 1), post(12, 1, None), post(13, 2, None),
                                   post(14, 1, 0), post(15, 3, 0)], POST)
    pages = ods.eligible_pages(managed, unmanaged)
    literal = sorted(r.post_id for r in ods.ods_posts(posts, pages).collect())
    strict = sorted(r.post_id for r in ods.ods_posts(posts, pages, strict_deleted=True).collect())
    # AND binds before OR: deleted or NULL-deleted posts of the unmanaged page are kept
    assert literal == [11, 13, 14]
    assert strict == [14]


def test_unmanaged_insights_dropped_and_managed_wins(spark):
    managed = spark.createDataFrame([(1, "a-b", "Facebook", " t ", "  ", 1, 1)], CLIENT)
    unmanaged = spark.createDataFrame([(1, "other", "facebook", "x", "", 0, 0), (2, "b", "instagram", "x", "", 0, 0),
                                       (3, "c", None, "x", "", 0, 0)], CLIENT)
    c = {r.client_id: r for r in clean.clean_clients(ods.ods_clients(managed, unmanaged)).collect()}
    assert sorted(c) == [1, 2]
    assert (c[1].name, c[1].managed, c[1].type, c[1].picture) == ("A-B", True, "t", None)


def test_dates_before_series_start(spark):
    ins = spark.createDataFrame(
        [(1, 7, dt.date(2009, 12, 31), '{"TN":3}'), (2, 7, dt.date(2010, 1, 1), '{"TN":4}')],
        "insight_id long, client_id int, insight_date date, page_fans_country string")
    for c in ods.INSIGHT_COUNTERS:
        ins = ins.withColumn(c, F.lit(1))
    ins = ins.withColumn("page_fans_city", F.lit(None).cast("string")).withColumn("page_fans_locale", F.lit(None).cast("string"))
    fi = {r.insight_id: r.date_id for r in dw.fact_insights(ins, dw.DATE_START, dt.date(2010, 12, 31)).collect()}
    assert fi == {1: None, 2: 1}
    fans = ods.fan_entries(ins, clean=True)
    locs = dw.dim_location(fans)
    demo = dw.fact_fan_demographics(fans, locs, dw.DATE_START, dt.date(2010, 12, 31))
    assert [r.insight_id for r in demo.collect()] == [2]


def test_video_table_holds_posts_of_any_page(spark):
    posts = spark.createDataFrame([post(10, 99, 1)], POST).withColumn(
        "data", F.lit('{"data":{"total_video_views":"5","total_video_views_paid":null}}'))
    v = ods.ods_data_video(posts).first()
    assert (v.post_id, v.total_video_views, v.total_video_views_paid) == (10, 5, None)
    assert v.created_at is not None


def test_ods_outputs_follow_ddl_order(spark):
    import __spark_entry__ as E
    from paths import SF001
    assert tuple(E.queries()["ods_posts"](spark, SF001).columns) == ods.POST_COLUMNS
    assert tuple(E.queries()["ods_insights"](spark, SF001).columns) == ods.INSIGHT_COLUMNS
    assert tuple(E.queries()["ods_clients"](spark, SF001).columns) == ods.CLIENT_COLUMNS


def test_fan_label_rejects(spark):
    ins = spark.createDataFrame([(1, 7, dt.date(2024, 1, 1), '{" Tunis ":1,"Tunis":2,"  ":5,"Sfax":3,"Sfax":4}')],
                                "insight_id long, client_id int, insight_date date, page_fans_country string")
    ins = ins.withColumn("page_fans_city", F.lit(None).cast("string")).withColumn("page_fans_locale", F.lit(None).cast("string"))
    got = sorted((r.field, r.reason) for r in rejects.fan_rejects(ins).collect())
    assert got == [("  ", "blank label"), ("Tunis", "label collides after trim")]


def test_fan_values_that_are_not_integers(spark):
    from pagemart.operators import bad_ints
    ins = spark.createDataFrame([(1, 7, dt.date(2024, 1, 1), '{"TN":"x","FR":3,"DE":"12.0","IT":null}')],
                                "insight_id long, client_id int, insight_date date, page_fans_country string")
    ins = ins.withColumn("page_fans_city", F.lit(None).cast("string")).withColumn("page_fans_locale", F.lit(None).cast("string"))
    rows = ods.fan_entries(ins, with_text=True)
    got = sorted((r.location_label, r.text) for r in bad_ints(rows, F.col("value_text"), ["location_label"]).collect())
    assert got == [("DE", "12.0"), ("TN", "x")]
    assert {r.location_label: r.nb_fans for r in rows.collect()} == {"TN": None, "FR": 3, "DE": None, "IT": None}
