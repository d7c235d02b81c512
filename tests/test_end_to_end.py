"""Landed responses -> streaming ingest -> staging versions -> refresh -> star schema."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from paths import SF001
from pagemart.plans.refresh import LayerStore, refresh
from pagemart.sources import landing
from pagemart.streaming.deltas import DeltaStore
from pagemart.streaming.ingest import STAGING_TABLES, daily_paths, start_ingest_stream


def test_landed_to_star_schema(spark, scratch):
    paths = daily_paths(os.path.join(scratch, "lake"), "2025-01-01")
    landed = landing.landed_responses(spark, SF001)
    # two landing files, processed as one available-now run
    landed.where(F.col("source") == "managed").write.parquet(os.path.join(paths["landing_dir"], "managed"))
    landed.where(F.col("source") == "unmanaged").write.parquet(os.path.join(paths["landing_dir"], "unmanaged"))
    start_ingest_stream(spark, paths["landing_dir"] + "/*", paths["root"], paths["checkpoint_dir"]).awaitTermination(300)

    staging = DeltaStore(spark, paths["root"])
    stg = {t: staging.read(t) for t in STAGING_TABLES}
    assert stg["stg_posts"].count() > 0 and stg["stg_insights"].count() > 0
    assert staging.read("stg_rejects").count() > 0

    dw = LayerStore(spark, os.path.join(scratch, "lake", "dw"))
    out = refresh(spark, stg, dw, start=dt.date(1990, 1, 1), end=dt.date(2025, 1, 1))
    fp, fi, fd = out["fact_posts"], out["fact_insights"], out["fact_fan_demographics"]
    assert fp.count() > 0 and fi.count() > 0 and fd.count() > 0
    # every key a fact carries exists in its dimension
    assert fp.join(out["dim_date"], "date_id", "left_anti").count() == 0
    assert fp.where(F.col("post_type_id").isNotNull()).join(out["dim_post_type"], "post_type_id", "left_anti").count() == 0
    assert fd.join(out["dim_location"], "location_id", "left_anti").count() == 0
    assert fi.where(F.col("date_id").isNull()).count() == 0
    # insights are kept for managed, eligible pages only: their client is a managed client
    managed_ids = out["dim_client"].where("managed").select("client_id")
    assert fi.join(managed_ids, "client_id", "left_anti").count() == 0
    assert out["ods_posts"].select("post_id").distinct().count() == out["ods_posts"].count()


def test_command_line_jobs(spark, scratch):
    from pagemart import jobs
    base = os.path.join(scratch, "lake2")
    day = "2025-02-01"
    landing.landed_responses(spark, SF001).write.parquet(os.path.join(base, "landed", day, "part-0"))
    version = jobs.main(["ingest", "--base", base, "--day", day, "--max-reject-ratio", "0.5"])
    assert version == "b000000000000"
    run = jobs.main(["refresh", "--base", base, "--day", day, "--start", "1990-01-01", "--end", "2025-01-01"])
    dwh = LayerStore(spark, os.path.join(base, "dw"))
    assert dwh.latest_run() == run
    assert dwh.read("fact_posts").count() > 0
