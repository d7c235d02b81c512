"""The whole refresh, layer by layer: staging -> ODS (cleaned) -> dimensions -> facts.

Every table is written as parquet under ``root/<table>/<run_id>``: a new directory per run, so
a job never overwrites what it reads and a failed run leaves the previous one intact. When all
tables are written, ``root/_runs/<run_id>`` is created; readers take the newest run that has
this marker ("write, then switch"). Writing a layer and reading it back also cuts the lineage
(no plan grows across layers, and a lost executor recomputes from the last written layer).

Dimensions are written before the facts so the ids the facts carry are the ids stored.

A store that knows its source (``LayerStore.source``) goes on where an earlier run stopped, and leaves tables as they are
whose inputs and settings did not change.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import clean, constraints, dw, ods
from .rejects import RejectedRows, refresh_rejects

MARKERS = "_runs"
STEPS = "_steps"
MARKER_SCHEMA = "run_id string, tab string, path string"
STEP_SCHEMA = "step string, path string"


@dataclass
class LayerStore:
    """Parquet tables of one run under a shared root folder.

    With ``source``, a text that names what the run starts from (the staging version), finished tables are remembered by their
    step: a hash of the table, its settings and the steps of its inputs. A table whose step was finished before, by a run
    that stopped later or by one with the same inputs, is taken as it is and not written again."""
    spark: SparkSession
    root: str
    run_id: str = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
                        + "-" + uuid.uuid4().hex[:8])
    mode: str = "errorifexists"  # "overwrite" for idempotent re-runs of one run id (streaming batches)
    source: str | None = None
    paths: dict[str, str] = field(default_factory=dict)      # tables of this run -> folder
    steps: dict[str, str] = field(default_factory=dict)      # tables of this run -> step
    reused: list[str] = field(default_factory=list)          # tables of this run that an earlier one had finished
    _finished: dict[str, str] | None = None

    def path(self, table: str, run_id: str | None = None) -> str:
        return f"{self.root.rstrip('/')}/{table}/{run_id or self.run_id}"

    def _markers(self, folder: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).json(f"{self.root.rstrip('/')}/{folder}/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def write(self, df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` as this run's ``table`` and return it read back (lineage cut here)."""
        w = df.write.mode(self.mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(table))
        self.paths[table] = self.path(table)
        return self.spark.read.parquet(self.path(table))

    def layer(self, table: str, build: Callable[[], DataFrame], inputs: Sequence[str] = (), settings: object = "",
              partition_by: list[str] | None = None) -> DataFrame:
        """``table``, built from the tables ``inputs`` of this run and, if it has none, from the source; ``settings`` are the parameters
        its rows depend on."""
        if self.source is None:
            return self.write(build(), table, partition_by)
        if self._finished is None:
            found = self._markers(STEPS, STEP_SCHEMA)
            self._finished = {r.step: r.path for r in found.collect()} if found is not None else {}     # one short row per table and run
        what = [table, repr(settings), repr(partition_by), *([self.steps[i] for i in inputs] or [self.source])]
        step = self.steps[table] = hashlib.sha256("\n".join(what).encode()).hexdigest()
        if step in self._finished:
            self.paths[table] = self._finished[step]
            self.reused.append(table)
            return self.spark.read.parquet(self.paths[table])
        df = self.write(build(), table, partition_by)
        # the marker comes after the table's files, so an unfinished table is never taken
        one = self.spark.range(1, numPartitions=1).select(F.lit(step).alias("step"), F.lit(self.paths[table]).alias("path"))
        one.write.mode("overwrite").json(f"{self.root.rstrip('/')}/{STEPS}/{step}")
        self._finished[step] = self.paths[table]
        return df

    def commit(self) -> None:
        # built JVM-side in one partition (a DataFrame from a Python list would be spread
        # over every core and need a Python worker per task just to write this marker)
        tables = sorted(self.paths) or [None]
        rows = F.array(*[F.struct(F.lit(self.run_id).alias("run_id"), F.lit(t).cast("string").alias("tab"), F.lit(self.paths.get(t)).cast("string").alias("path")) for t in tables])
        marker = self.spark.range(1, numPartitions=1).select(F.inline(rows))
        marker.write.mode(self.mode).json(f"{self.root.rstrip('/')}/{MARKERS}/{self.run_id}")

    def latest_run(self, before: str | None = None) -> str | None:
        """Newest committed run id (run ids sort by their UTC start time), optionally the
        newest one that sorts before ``before``. Reads the small commit markers only."""
        markers = self._markers(MARKERS, MARKER_SCHEMA)
        if markers is None:
            return None  # no run committed yet
        if before is not None:
            markers = markers.where(F.col("run_id") < F.lit(before))
        return markers.agg(F.max("run_id")).first()[0]

    def last_of(self, table: str) -> DataFrame | None:
        """``table`` of the newest committed run that has it, None if none does."""
        markers = self._markers(MARKERS, MARKER_SCHEMA)
        last = markers.where(F.col("tab") == F.lit(table)).agg(F.max_by("path", "run_id")).first()[0] if markers is not None else None
        return self.spark.read.parquet(last) if last else None

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        """A table of the given run (default: the newest committed run)."""
        run = run_id or self.latest_run()
        if run is None:
            raise FileNotFoundError(f"no committed run under {self.root}")
        markers = self._markers(MARKERS, MARKER_SCHEMA)
        kept = markers.where((F.col("run_id") == F.lit(run)) & (F.col("tab") == F.lit(table))).first() if markers is not None else None
        return self.spark.read.parquet(kept.path if kept else self.path(table, run))


def refresh(spark: SparkSession, staging: dict[str, DataFrame], store: LayerStore, start: dt.date = dw.DATE_START,
            end: dt.date | None = None, strict_deleted: bool = False, carry_clicks: bool = False,
            partition_facts_by_year: bool = False, strict: bool = False, keep_keys: bool = False) -> dict[str, DataFrame]:
    """Run ODS, cleaning and DW from the four staging tables (``stg_clients``,
    ``stg_unmanaged_clients``, ``stg_posts``, ``stg_insights``); returns the written tables.

    Cleaning is fused into each ODS job (one pass, the stored ODS tables are the cleaned ones,
    as after the load's UPDATE statements). ``end`` of the date dimension defaults to today
    (UTC); facts use the same bounds. ``partition_facts_by_year`` writes each fact partitioned
    by the calendar year of its date key (an extra ``year`` column; NULL for facts outside the
    date dimension), so readers that filter on dates skip whole folders.

    ``rejects`` holds every value that could not be loaded (bad JSON, bad integers, labels dropped by
    cleaning) and ``broken_keys`` every violated key of the written tables; with ``strict`` a run
    with rejects, or with a repeated primary key in the staging tables or the ODS, stops before it is committed.

    With ``keep_keys`` the ids of post types and locations continue those of the last committed run under ``store.root`` that
    kept them: known labels keep their id, new ones are appended (tables ``keys_post_type``, ``keys_location``). Otherwise every run
    numbers its labels from 1."""
    end = end or dw.today_utc()
    stg_c, stg_u = staging["stg_clients"], staging["stg_unmanaged_clients"]
    stg_p, stg_i = staging["stg_posts"], staging["stg_insights"]
    out: dict[str, DataFrame] = {}

    # ODS (eligible pages are computed once and shared by posts and insights)
    pages = store.layer("eligible_pages", lambda: ods.eligible_pages(stg_c, stg_u))
    out["ods_clients"] = store.layer("ods_clients", lambda: clean.clean_clients(ods.ods_clients(stg_c, stg_u)))
    loaded = (strict_deleted, carry_clicks)

    def posts_with_payload() -> DataFrame:
        return clean.clean_posts(ods.ods_posts(stg_p, pages, *loaded, keep_payload=True))
    out["ods_posts"] = store.layer("ods_posts", lambda: posts_with_payload().drop("data"), ["eligible_pages"], (store.source, loaded))
    out["ods_insights"] = store.layer("ods_insights", lambda: clean.clean_insights(ods.ods_insights(stg_i, pages)), ["eligible_pages"], store.source)
    fan_rows = store.layer("ods_fans", lambda: ods.fan_entries(out["ods_insights"], clean=True), ["ods_insights"], partition_by=["location_type"])
    for kind, (_, label, _) in ods.FAN_KINDS.items():
        out[f"ods_fans_{kind}"] = fan_rows.where(F.col("location_type") == kind).select(
            "insight_id", "client_id", "insight_date", F.col("location_label").alias(label), "nb_fans")
    out["ods_data_video"] = store.layer("ods_data_video", lambda: ods.ods_data_video(stg_p))

    out["rejects"] = store.layer("rejects", lambda: refresh_rejects(stg_p, ods.ods_insights(stg_i, pages), carry_clicks),
                                 ["eligible_pages"], (store.source, carry_clicks))
    if strict:
        # one job for both: it stops at the first thing found
        keys = constraints.violations(staging | out, [constraints.PRIMARY])
        bad = out["rejects"].select(F.to_json(F.struct("*")).alias("found")).unionByName(keys.select(F.to_json(F.struct("*")).alias("found"))).first()
        if bad:
            raise RejectedRows(f"run {store.run_id}: {bad.found}")

    # dimensions, written before the facts that carry their ids
    series = (str(start), str(end))
    out["dim_date"] = store.layer("dim_date", lambda: dw.dim_date(spark, start, end), settings=series)
    out["dim_client"] = store.layer("dim_client", lambda: dw.dim_client(out["ods_clients"]), ["ods_clients"])
    for table, source, labels, key, id_col in (
            ("post_type", "ods_posts", lambda: dw.post_type_labels(out["ods_posts"]), ["label"], "post_type_id"),
            ("location", "ods_fans", lambda: dw.location_labels(fan_rows), dw.LOCATION_KEY, "location_id")):
        def registry(labels=labels, key=key, id_col=id_col, known=None) -> DataFrame:
            return dw.registered(labels(), key, id_col, known)
        if keep_keys:
            known = store.last_of(f"keys_{table}")
            kept = store.layer(f"keys_{table}", lambda: registry(known=known), [source], known.inputFiles() if known else None)
            out[f"dim_{table}"] = store.layer(f"dim_{table}", lambda: kept.where("current").select(id_col, *key), [f"keys_{table}"])
        else:
            out[f"dim_{table}"] = store.layer(f"dim_{table}", lambda: registry().select(id_col, *key), [source])

    # facts. The post fact takes the video counters from the same staged row as the post (the
    # video table is a projection of it), which replaces a shuffle join of two post-sized tables.
    def fact(name: str, build: Callable[[], DataFrame], inputs: list[str]) -> DataFrame:
        if not partition_facts_by_year:
            return store.layer(name, build, inputs, series)
        year = F.year(F.date_add(F.lit(start), F.col("date_id") - 1))
        return store.layer(name, lambda: build().withColumn("year", year), inputs, series, ["year"])

    out["fact_posts"] = fact("fact_posts", lambda: dw.fact_posts(posts_with_payload(), out["dim_post_type"], None, start, end), ["ods_posts", "dim_post_type"])
    out["fact_insights"] = fact("fact_insights", lambda: dw.fact_insights(out["ods_insights"], start, end), ["ods_insights"])
    out["fact_fan_demographics"] = fact("fact_fan_demographics", lambda: dw.fact_fan_demographics(fan_rows, out["dim_location"], start, end),
                                        ["ods_fans", "dim_location"])
    out["broken_keys"] = store.layer("broken_keys", lambda: constraints.violations(staging | out),
                                     [t for t in out if t in store.steps], store.source)
    store.commit()
    return out
