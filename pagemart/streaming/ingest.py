"""Incremental ingest of landed page responses with Structured Streaming.

Landed responses arrive as files (parquet or JSON lines with the columns of
``sources.responses``). A file-source stream picks up new files; each micro-batch is staged
with the same rules as the batch ingest and written as one delta of every staging table
(``streaming.deltas``): a batch writes its own volume, not the load's. Readers merge the deltas.

The deltas of a batch are named after its batch id and its marker is written last, so a batch
that is retried after a failure rewrites the same deltas (idempotent), and readers only see
committed batches (``DeltaStore.read``). Rejected pages of each batch are kept
with it. ``trigger(availableNow=True)`` processes everything landed so far and stops,
which is how a daily run uses it; a continuous trigger works the same way.

Order: records are ordered by (list, list position, response page, array position). Staging keeps the
order of the record behind every stored value (column ``__order``), so the result does not depend on
how the responses are split into batches, nor on the order the batches come in.

Staging is a full refresh per load (the run empties it first): give each load (e.g. each day) its
own ``landing_dir``, ``root`` and checkpoint folder, see ``daily_paths``. Within a load, deltas
build on each other; a new load starts from nothing. ``compact_every`` merges them into the base
whenever so many are open.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.responses import RejectedTooMany, ingest
from .deltas import DeltaStore

LANDED_SCHEMA = ("source string, source_rank int, list_pos bigint, page_id int, chunk int, status int, "
                 "body string")
STAGING_TABLES = ("stg_clients", "stg_unmanaged_clients", "stg_insights", "stg_posts")


def version_id(batch_id: int) -> str:
    return f"b{batch_id:012d}"


def stage_batch(spark: SparkSession, batch: DataFrame, root: str, batch_id: int,
                max_reject_ratio: float | None = None, compact_every: int | None = None) -> DeltaStore:
    """Stage one batch of landed responses as the deltas of ``batch_id`` under ``root`` and commit
    them. A batch with too many rejected responses fails before its commit marker, so readers never see it."""
    ensure_checkpoint_dir(spark)
    staged = ingest(batch, track_order=True).materialize()  # validate once for all five outputs
    store = DeltaStore(spark, root, run_id=version_id(batch_id), mode="overwrite")

    def write(table: str) -> DataFrame | None:
        df = getattr(staged, table.removeprefix("stg_"))        # planning it looks for repeated ids
        return store.write(df, table) if table == "stg_rejects" else store.write_delta(df, table)
    # the outputs do not depend on each other: while the last tasks of one run, the next one's take the free cores
    with ThreadPoolExecutor(len(STAGING_TABLES) + 1) as pool:
        *deltas, rejected = [pool.submit(inheritable_thread_target(spark)(write), t) for t in (*reversed(STAGING_TABLES), "stg_rejects")]
    for done in deltas:
        done.result()
    rejects = rejected.result()
    staged.release()
    if max_reject_ratio is not None:
        # from what was written: no second validation pass; the version stays uncommitted
        landed, bad = batch.count(), rejects.count()
        if landed and bad / landed > max_reject_ratio:
            raise RejectedTooMany(f"batch {batch_id}: {bad} of {landed} responses rejected "
                                  f"(limit {max_reject_ratio:.1%})")
    store.commit()
    if compact_every is not None and store.open_deltas() >= compact_every:
        store.compact(STAGING_TABLES)
    return store


def daily_paths(base: str, day: str) -> dict[str, str]:
    """Folders of one daily load under a shared ``base``: landed files, staging versions, stream
    checkpoint."""
    base = base.rstrip("/")
    return {"landing_dir": f"{base}/landed/{day}", "root": f"{base}/staging/{day}",
            "checkpoint_dir": f"{base}/checkpoints/ingest/{day}"}


def start_ingest_stream(spark: SparkSession, landing_dir: str, root: str, checkpoint_dir: str,
                        fmt: str = "parquet", available_now: bool = True, max_files_per_trigger: int | None = None,
                        max_reject_ratio: float | None = None, entries: DataFrame | None = None,
                        compact_every: int | None = None):
    """Start the stream; returns the ``StreamingQuery``. ``entries`` (``pagelists.list_entries``) supplies source_rank and list_pos;
    responses of pages that are on no list keep their own."""
    # landed files may sit in sub-folders (one per fetcher, hour, ...)
    reader = spark.readStream.format(fmt).schema(LANDED_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.load(landing_dir)
    if entries is not None:
        listed = (entries.where("page_id IS NOT NULL").groupBy("source", "page_id")
                  .agg(F.min("source_rank").alias("r"), F.min("list_pos").alias("p")))
        landed = landed.join(listed, ["source", "page_id"], "left").select(
            "source", F.coalesce("r", "source_rank").alias("source_rank"), F.coalesce("p", "list_pos").alias("list_pos"),
            "page_id", "chunk", "status", "body")
    writer = (landed.writeStream
              .foreachBatch(lambda df, batch_id: stage_batch(spark, df, root, batch_id, max_reject_ratio, compact_every))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
