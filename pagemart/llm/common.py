"""Helpers shared by the training-data operators: table access, materialised steps, document keys,
skew-safe lookups and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# A key is hot when it holds more than 1/HOT_KEYS of all rows, so at most HOT_KEYS keys are hot: that
# is the proven size bound of every broadcast of hot keys.
HOT_KEYS = 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder of ``spark.checkpoint.dir`` and read it back:
    later steps start from a file that survives lost executors. The folder is removed with the
    application."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` of a function of one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield fn(b)
    return df.mapInArrow(returning(run), schema)


def returning(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function for ``mapInArrow``, that gives Arrow's unused memory back after each result and at its end: Python workers
    stay for later steps, and with them what they hold."""
    def returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()
        del batches
        pa.default_memory_pool().release_unused()
    return returned


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string or binary column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def each_bytes(column: pa.Array) -> Iterator[bytes]:
    """As ``as_bytes``, one row at a time: only the Arrow batch is held whole."""
    return (x.as_py() or b"" for x in column.cast(pa.binary()))


def each_text(column: pa.Array) -> Iterator[str]:
    """As ``as_text``, one row at a time."""
    return (x.decode("utf-8", "replace") for x in each_bytes(column))


def as_text(column: pa.Array) -> list[str]:
    """Texts of a string or binary column; null is empty, broken UTF-8 becomes U+FFFD."""
    return [x.decode("utf-8", "replace") for x in as_bytes(column)]


def doc_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two never-null columns that identify a document: its id and a hash of its text, so rows that
    share an id but not a text (or have no id) are different documents; repeated rows are one."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2 ** 63))).alias("k_id"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("k_text")]


def sheltered(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns called own_0, own_1, ..., so that no name clashes with a helper column, and the new
    names of the columns ``needed``."""
    names = [f"own_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), [names[docs.columns.index(c)] for c in needed]


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per key, ``n`` = the key's row count in
    ``rows``, never null). Hot keys are joined by a broadcast of their bounded table rows, so no task
    gets all rows of a hot key; the others by a shuffle join, whatever the size of ``table``."""
    limit = max(1000, total // HOT_KEYS)
    hot = table.where(F.col(n) > limit)
    rest = table.where(F.col(n) <= limit)
    few = rows.join(F.broadcast(hot), keys)
    many = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest.hint("merge"), keys)
    return few.unionByName(many)


def components(links: DataFrame, what: str = "links") -> DataFrame:
    """Connected components of undirected ``links(a long, b long)``: rows (node, root), one per
    node that has a link; ``root`` is some node of its component.

    Contraction: every node points to its neighbour (or itself) of lowest random priority, links
    are re-labelled with the pointers, loops and repeats go, until none is left (expected
    logarithmic rounds, chains included). The rounds' pointers are then followed for all nodes."""
    def edges(df: DataFrame) -> DataFrame:
        return (df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct())
    left = settle(edges(links), what)
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        def rank(c: str) -> Column:
            return F.struct(F.xxhash64(F.col(c), F.lit(len(rounds))).alias("h"), F.col(c).alias("node"))
        both = left.select("a", "b").union(left.select("b", "a")).toDF("a", "b")
        pointer = settle(both.groupBy("a").agg(F.min(rank("b")).alias("m"))
                         .select(F.col("a").alias("node"), F.least("m", rank("a"))["node"].alias("up")), what)
        rounds.append(pointer)
        pa_, pb = pointer.toDF("a", "ua"), pointer.toDF("b", "ub")
        left = settle(edges(left.join(pa_, "a").join(pb, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b"))), what)
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[0].toDF("node", "root")
    for later in rounds[1:]:
        roots = (roots.join(later.toDF("root", "next"), "root", "left")
                 .select("node", F.coalesce("next", "root").alias("root")))
    return settle(roots, what)
