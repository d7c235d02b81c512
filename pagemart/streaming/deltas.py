"""Staging tables kept as a base and deltas.

A batch of records writes one delta per table: the rows of its own keys, with the order of the record each value comes
from (``__order``). Nothing stored before is read or rewritten. Readers merge on read: per key and column the value of
the latest record wins, whatever delta it lies in. The merge is associative and ignores how records were split, so any
batches and any compactions give the same table.

Compaction rewrites buckets (a hash of the key): a bucket's base and the deltas not yet in it become its new base. Any
subset of the buckets can be compacted at a time; files are added, never changed, and the state that names the current base
of every bucket is written last.

    <root>/<table>/delta/version=<batch>/          rows of one batch, sorted by bucket
    <root>/<table>/base/version=<state>/bucket=<k> merged rows of one bucket
    <root>/_runs/<batch>                           marker of a committed batch
    <root>/_base/<state>                           per table and bucket: its base and the last batch in it
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.upsert import merge_tracked, repeated_keys
from ..plans.refresh import MARKERS, LayerStore
from ..sources.responses import ORDER
from ..storage import remove

BUCKETS = 64
STATES = "_base"
STATE_SCHEMA = "tab string, bucket int, base string, through string"


@dataclass
class DeltaStore(LayerStore):
    """Staging tables under ``root``; ``run_id`` is the version of the batch this store writes. ``buckets`` is fixed
    for the life of a root."""
    key: str = "id"
    buckets: int = BUCKETS

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket")

    def write_delta(self, df: DataFrame, table: str) -> None:
        """This batch's rows of ``table`` (one per key, with ``__order``). Rewrites only what an earlier try of the same batch wrote.
        Batches are named in ascending order, as a stream does; a new one that sorts before a compacted one is refused."""
        _, states = self._states()
        if self.run_id not in self.versions() and any(r.through > self.run_id for r in states):
            raise ValueError(f"batch {self.run_id} comes after a compaction beyond it")
        path = f"{self.root.rstrip('/')}/{table}/delta/version={self.run_id}"
        df.select("*", self._bucket()).sortWithinPartitions("bucket").write.mode("overwrite").parquet(path)

    def versions(self) -> list[str]:
        """Committed batches, oldest first (one short name per batch)."""
        markers = self._markers(MARKERS, "run_id string")
        return sorted(r.run_id for r in markers.distinct().collect()) if markers is not None else []

    def _states(self) -> tuple[str | None, list]:
        """Name and rows of the newest state (one row per table and bucket)."""
        rows = self._markers(STATES, STATE_SCHEMA)
        if rows is None:
            return None, []
        rows = rows.withColumn("state", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        last = rows.agg(F.max("state")).first()[0]
        return last, rows.where(F.col("state") == F.lit(last)).collect()

    def _parts(self, table: str, states: list, versions: list[str], buckets: Iterable[int] | None = None) -> DataFrame:
        """All stored rows of ``table`` that are current: the bases, and the deltas of ``versions`` that are not in their bucket's base."""
        top = f"{self.root.rstrip('/')}/{table}"
        wanted = set(range(self.buckets) if buckets is None else buckets)
        own = [r for r in states if r.tab == table and r.bucket in wanted]
        through = {r.bucket: r.through for r in own}
        oldest = min((through.get(b, "") for b in wanted), default="")
        open_ = [v for v in versions if v > oldest]
        schema = self.spark.read.parquet(f"{top}/delta/version={versions[-1]}").schema
        stored = StructType([f for f in schema.fields if f.name != "bucket"])
        full = StructType([*stored.fields, StructField("bucket", IntegerType()), StructField("version", StringType())])
        parts = []
        if open_:
            deltas = self.spark.read.schema(full).option("basePath", f"{top}/delta").parquet(*[f"{top}/delta/version={v}" for v in open_])
            if buckets is not None:
                deltas = deltas.where(F.col("bucket").isin(sorted(wanted)))
            late = sorted(set(through.values()))
            if len(late) > 1 or (late and len(through) < len(wanted)):      # buckets differ in what their base holds
                merged = F.create_map(*[F.lit(x) for b, v in through.items() for x in (b, v)])
                deltas = deltas.where(F.col("version") > F.coalesce(F.try_element_at(merged, F.col("bucket")), F.lit("")))
            parts.append(deltas)
        bases = [f"{top}/base/version={r.base}/bucket={r.bucket}" for r in own if r.base]
        if bases:
            parts.append(self.spark.read.schema(full).option("basePath", f"{top}/base").parquet(*bases))
        if not parts:
            return self.spark.createDataFrame([], full).drop("version")
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return rows.drop("version")

    def _merged(self, rows: DataFrame) -> tuple[DataFrame, str]:
        """One row per key, and the folder of what this wrote: the keys that lie in several parts. Rows of other keys stay as they are."""
        columns = [c for c in rows.columns if c not in ("bucket", self.key, ORDER)]
        repeated, path = repeated_keys(rows, self.key)
        several = merge_tracked(rows.join(repeated, self.key, "left_semi"), [self.key], columns, ORDER)
        return rows.join(repeated, self.key, "left_anti").select(*several.columns).unionByName(several), path

    def read(self, table: str, run_id: str | None = None, with_order: bool = False) -> DataFrame:
        """``table`` after all committed batches (up to ``run_id``, if given). Tables that are not kept as deltas are those of the batch."""
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"no committed run under {self.root}")
        if not table.startswith("stg_") or table == "stg_rejects":
            return super().read(table, run_id)
        _, states = self._states()
        if run_id is not None:
            if any(r.through > run_id for r in states if r.tab == table):
                raise ValueError(f"{table} is compacted beyond {run_id}")
            versions = [v for v in versions if v <= run_id]
        merged, _ = self._merged(self._parts(table, states, versions))
        return merged if with_order else merged.drop(ORDER)

    def open_deltas(self) -> int:
        """Committed batches that are not yet in every bucket's base."""
        _, states = self._states()
        done = min((r.through for r in states), default="")
        return sum(v > done for v in self.versions())

    def compact(self, tables: Iterable[str], buckets: Iterable[int] | None = None) -> str | None:
        """Merge the committed deltas into the base of ``buckets`` (default: all) of ``tables``; returns the new state's name. A run
        that stops before the state is written changes nothing for readers."""
        versions = self.versions()
        if not versions:
            return None
        last, states = self._states()
        name = f"{int(last or 0) + 1:012d}"
        some = sorted(set(range(self.buckets) if buckets is None else buckets))
        fresh = []
        for table in tables:
            path = f"{self.root.rstrip('/')}/{table}/base/version={name}"
            rows = self._parts(table, states, versions, some)
            merged, scratch = self._merged(rows)
            merged.select("*", self._bucket()).repartition(len(some), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
            remove(self.spark, scratch)
            try:
                filled = {r.bucket for r in self.spark.read.schema("bucket int").parquet(path).select("bucket").distinct().collect()}
            except AnalysisException:
                filled = set()                                     # no row at all
            fresh += [(table, b, name if b in filled else None, versions[-1]) for b in some]
        kept = [(r.tab, r.bucket, r.base, r.through) for r in states if (r.tab, r.bucket) not in {f[:2] for f in fresh}]
        state = self.spark.createDataFrame(kept + fresh, STATE_SCHEMA).coalesce(1)
        state.write.mode("overwrite").json(f"{self.root.rstrip('/')}/{STATES}/{name}")
        return name
