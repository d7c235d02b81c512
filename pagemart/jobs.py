"""Command-line entry points for a scheduler (``spark-submit -m``-style or ``python -m``):

    python -m pagemart.jobs ingest  --base s3://lake/pagemart --day 2025-01-31 [--max-reject-ratio 0.2]
    python -m pagemart.jobs compact --base s3://lake/pagemart --day 2025-01-31
    python -m pagemart.jobs refresh --base s3://lake/pagemart --day 2025-01-31 [--start 2010-01-01] [--end ...]

``ingest`` stages the responses landed under ``<base>/landed/<day>`` (Structured Streaming,
available-now: every file not yet staged) as deltas under ``<base>/staging/<day>``; ``compact``
merges them into a base (optional). ``refresh`` reads the committed staging of that day and writes ODS, dimensions and facts as a new run
under ``<base>/dw``. The session comes from the environment (``spark-submit`` settings); the
stream checkpoint lives under ``<base>/checkpoints``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .plans.dw import DATE_START
from .plans.refresh import LayerStore, refresh
from .sources import pagelists
from .streaming.deltas import DeltaStore
from .streaming.ingest import LANDED_SCHEMA, STAGING_TABLES, daily_paths, start_ingest_stream


# Only settings the results depend on; everything else (shuffle width, AQE, UI, memory) is the
# cluster's, from spark-submit / spark-defaults (see session.CLUSTER_CONF for a starting point).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("pagemart")
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def run_ingest(spark: SparkSession, base: str, day: str, max_reject_ratio: float | None = None,
               fmt: str = "parquet", managed_list: str | None = None, unmanaged_list: str | None = None) -> str | None:
    """Stage the day's landed responses; returns the committed staging version. With the two page lists, ``source_rank`` and
    ``list_pos`` of a response come from them, and the listed pages without a response are written as
    ``<base>/staging/<day>/stg_missing_pages``."""
    p = daily_paths(base, day)
    entries = None
    if managed_list and unmanaged_list:
        entries = pagelists.list_entries(pagelists.read_managed_list(spark, managed_list),
                                         pagelists.read_unmanaged_list(spark, unmanaged_list))
        landed = spark.read.format(fmt).schema(LANDED_SCHEMA).option("recursiveFileLookup", "true").load(p["landing_dir"])
        pagelists.without_response(entries, landed).write.mode("overwrite").parquet(f"{p['root']}/stg_missing_pages")
    query = start_ingest_stream(spark, p["landing_dir"], p["root"], p["checkpoint_dir"], fmt=fmt,
                                max_reject_ratio=max_reject_ratio, entries=entries)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"ingest of {day} failed") from None
    return LayerStore(spark, p["root"]).latest_run()


def run_compact(spark: SparkSession, base: str, day: str) -> str | None:
    """Merge the day's staged batches into the base of its staging tables; returns the name of the new state."""
    return DeltaStore(spark, daily_paths(base, day)["root"]).compact(STAGING_TABLES)


def run_refresh(spark: SparkSession, base: str, day: str, start: dt.date = DATE_START,
                end: dt.date | None = None, partition_facts_by_year: bool = False, strict_deleted: bool = False,
                carry_clicks: bool = False, strict: bool = False, keep_keys: bool = False) -> str:
    """ODS, dimensions and facts from the day's newest staging version; returns the run id."""
    staging = DeltaStore(spark, daily_paths(base, day)["root"])
    version = staging.latest_run()
    if version is None:
        raise FileNotFoundError(f"no committed staging for {day} under {base}")
    # a run that stopped is continued, and tables whose inputs did not change are not written again
    store = LayerStore(spark, f"{base.rstrip('/')}/dw", source=f"{day} {version}")
    # merged and written once: the refresh reads each table several times
    tables = {t: store.layer(t, lambda t=t: staging.read(t, version)) for t in STAGING_TABLES}
    refresh(spark, tables, store, start=start, end=end, partition_facts_by_year=partition_facts_by_year,
            strict_deleted=strict_deleted, carry_clicks=carry_clicks, strict=strict, keep_keys=keep_keys)
    return store.run_id


def main(argv: list[str] | None = None) -> str | None:
    ap = argparse.ArgumentParser(prog="pagemart.jobs")
    ap.add_argument("command", choices=["ingest", "compact", "refresh"])
    ap.add_argument("--base", required=True, help="shared folder holding landed/, staging/, dw/, checkpoints/")
    ap.add_argument("--day", required=True, help="load day, YYYY-MM-DD")
    ap.add_argument("--max-reject-ratio", type=float, default=None)
    ap.add_argument("--format", default="parquet", help="format of the landed files (parquet or json)")
    ap.add_argument("--start", type=dt.date.fromisoformat, default=DATE_START, help="first day of dim_date")
    ap.add_argument("--end", type=dt.date.fromisoformat, default=None, help="last day of dim_date (default today)")
    ap.add_argument("--partition-facts-by-year", action="store_true", help="write facts partitioned by year")
    ap.add_argument("--strict-deleted", action="store_true", help="drop deleted posts of unmanaged pages too")
    ap.add_argument("--carry-clicks", action="store_true", help="load the click map")
    ap.add_argument("--strict", action="store_true", help="stop on values that cannot be loaded and on repeated keys")
    ap.add_argument("--keep-keys", action="store_true", help="label ids continue those of the last run")
    ap.add_argument("--managed-list", default=None, help="managed page list (JSON document)")
    ap.add_argument("--unmanaged-list", default=None, help="unmanaged page list (JSON document)")
    args = ap.parse_args(argv)
    spark = _session()
    if args.command == "ingest":
        return run_ingest(spark, args.base, args.day, args.max_reject_ratio, args.format,
                          args.managed_list, args.unmanaged_list)
    if args.command == "compact":
        return run_compact(spark, args.base, args.day)
    return run_refresh(spark, args.base, args.day, args.start, args.end, args.partition_facts_by_year,
                       args.strict_deleted, args.carry_clicks, args.strict, args.keep_keys)


if __name__ == "__main__":
    main()
