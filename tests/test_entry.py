"""Driver contract and whole-result properties of the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as E
from paths import SF001, SF01
from pagemart.registry import Layers


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "post_id" in df.columns and "date_id" in df.columns


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_fact_keys_exist_in_dims(spark):
    L = Layers(spark, SF01)
    fp, fi, fd = L.fact_posts(), L.fact_insights(), L.fact_fan_demographics()
    dates, types, locs = L.dim_date(), L.dim_post_type, L.dim_location
    assert fp.where(F.col("date_id").isNotNull()).join(dates, "date_id", "left_anti").count() == 0
    assert fi.where(F.col("date_id").isNotNull()).join(dates, "date_id", "left_anti").count() == 0
    assert fp.where(F.col("post_type_id").isNotNull()).join(types, "post_type_id", "left_anti").count() == 0
    assert fd.join(locs, "location_id", "left_anti").count() == 0
    assert fd.count() <= L.clean_fan_rows.count()


def test_default_start_puts_old_posts_outside_date_dim(spark):
    L = Layers(spark, SF01)
    # posts are dated 1995-2001, before the series start (2010-01-01): every date_id is NULL
    assert L.fact_posts().where(F.col("date_id").isNotNull()).count() == 0
    # insights are dated 2024: every date_id is set
    assert L.fact_insights().where(F.col("date_id").isNull()).count() == 0


def test_earlier_start_keys_every_post(spark):
    import datetime as dt
    L = Layers(spark, SF01, start=dt.date(1995, 1, 1))
    fp = L.fact_posts()
    assert fp.where(F.col("date_id").isNull()).count() == 0
    assert fp.where(F.col("post_id") == 0).select("date_id").first()[0] == \
        (dt.date(1998, 10, 3) - dt.date(1995, 1, 1)).days + 1


def test_rerun_gives_same_result(spark):
    a = E.queries()["fact_fan_demographics"](spark, SF001).collect()
    b = E.queries()["fact_fan_demographics"](spark, SF001).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
