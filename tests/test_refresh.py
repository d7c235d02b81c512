"""The layer-by-layer refresh writes tables equal to the registered queries, and a second run
leaves the first intact."""

from __future__ import annotations

import pytest

import datetime as dt

from pyspark.sql import functions as F

from paths import SF01
from pagemart.plans.rejects import RejectedRows
from pagemart.plans.refresh import LayerStore, refresh
from pagemart.registry import Layers
from pagemart.sources import testdata


def same_rows(a, b, cols=None):
    cols = cols or sorted(a.columns)
    ra = sorted(map(lambda r: tuple(map(str, r)), a.select(*cols).collect()))
    rb = sorted(map(lambda r: tuple(map(str, r)), b.select(*cols).collect()))
    return ra == rb


def test_refresh_matches_registered_queries(spark, scratch):
    stg = testdata.Staging(spark, SF01)
    staging = {"stg_clients": stg.clients, "stg_unmanaged_clients": stg.unmanaged_clients,
               "stg_posts": stg.posts, "stg_insights": stg.insights}
    store = LayerStore(spark, scratch)
    end = dt.date(2025, 1, 1)
    out = refresh(spark, staging, store, end=end)
    L = Layers(spark, SF01)

    assert same_rows(out["ods_clients"], L.clean_clients())
    assert same_rows(out["ods_posts"], L.clean_posts())
    assert same_rows(out["ods_insights"], L.clean_insights())
    assert same_rows(out["dim_post_type"], L.dim_post_type)
    assert same_rows(out["dim_location"], L.dim_location)
    assert same_rows(out["fact_posts"], L.fact_posts())
    assert same_rows(out["fact_insights"], L.fact_insights())
    demo = out["fact_fan_demographics"]
    assert same_rows(demo.drop("fact_id"), L.fact_fan_demographics())
    ids = demo.agg(F.min("fact_id").alias("a"), F.max("fact_id").alias("b"), F.count_distinct("fact_id").alias("n")).first()
    assert (ids.a, ids.b) == (1, ids.n) and ids.n == demo.count()
    assert out["ods_data_video"].where(F.col("created_at").isNull()).count() == 0
    assert out["dim_date"].agg(F.max("full_date")).first()[0] == end

    # what could not be loaded is reported: rows in = rows out + rejects, key checks over the run's own tables
    assert out["rejects"].count() > 0
    assert {r.reason for r in out["rejects"].select("reason").distinct().collect()} >= {"not one JSON object", "not an integer", "blank label"}
    assert out["broken_keys"].where("broken LIKE 'primary%' OR broken LIKE 'unique%'").count() == 0
    with pytest.raises(RejectedRows):
        refresh(spark, staging, LayerStore(spark, scratch + "-strict"), end=end, strict=True)
    assert LayerStore(spark, scratch + "-strict").latest_run() is None

    # the newest committed run is the one just written; a second run gets its own folder
    assert store.latest_run() == store.run_id
    first = store.run_id
    store2 = LayerStore(spark, scratch)
    refresh(spark, staging, store2, end=end)
    assert store2.latest_run() == store2.run_id != first
    assert same_rows(store2.read("fact_posts"), store.read("fact_posts", first))


def test_facts_partitioned_by_year_prune(spark, scratch):
    stg = testdata.Staging(spark, SF01)
    staging = {"stg_clients": stg.clients, "stg_unmanaged_clients": stg.unmanaged_clients,
               "stg_posts": stg.posts, "stg_insights": stg.insights}
    store = LayerStore(spark, scratch)
    out = refresh(spark, staging, store, start=dt.date(1995, 1, 1), end=dt.date(2025, 1, 1),
                  partition_facts_by_year=True)
    fp = out["fact_posts"]
    assert "year" in fp.columns
    assert fp.where("year = 1998").count() == fp.where(F.col("date_id").between(
        (dt.date(1998, 1, 1) - dt.date(1995, 1, 1)).days + 1, (dt.date(1998, 12, 31) - dt.date(1995, 1, 1)).days + 1)).count()
    plan = fp.where("year = 1998")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
