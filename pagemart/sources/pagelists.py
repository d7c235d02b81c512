"""Page lists: which pages to fetch, in which order.

The managed list is one JSON document ``{success, message, data: [{id, name, social_type,
managed}]}``; the unmanaged list's entries are ``{page: {id}}`` or ``{id}``. A document is parsed
whole by one task (JSON documents do not split); a list that grows large should be landed as JSON
lines (``multiline=False``: one entry per line), whose blocks are read by as many tasks. Places in the list come
from counts per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import written

MANAGED_LIST = "success boolean, message string, data array<struct<id:string, name:string, social_type:string, managed:int>>"
MANAGED_ENTRY = "id string, name string, social_type string, managed int"
# ids are read as text: a list may hold them as numbers or as strings
UNMANAGED_LIST = "data array<struct<id:string, page:struct<id:string>>>"
UNMANAGED_ENTRY = "id string, page struct<id:string>"

MANAGED, UNMANAGED = "managed", "unmanaged"
SOURCE_RANK = {MANAGED: 0, UNMANAGED: 1}  # the managed list is fetched first


def _entries(spark: SparkSession, path: str, doc_schema: str, entry_schema: str, multiline: bool) -> DataFrame:
    """Entries with ``list_pos``, their place in file order (files by name). A cut or malformed document, and one
    without ``data``, stop the read."""
    reader = spark.read.option("mode", "FAILFAST")
    if multiline:
        docs = reader.schema(doc_schema).option("multiLine", True).json(path).select("*", F.col("_metadata.file_path").alias("__file"))
        data = F.when(F.col("data").isNull(), F.raise_error(F.concat(F.lit("page list without data: "), F.col("__file")))
                      .cast(docs.schema["data"].dataType)).otherwise(F.col("data"))
        rows = docs.select(F.struct("__file").alias("__block"), F.posexplode(data).alias("__at", "e")).select("__block", F.col("__at").cast("bigint").alias("__at"), "e.*")
    else:
        # a block of a file is read by one task, in order; which blocks a task gets does not matter
        rows = (reader.schema(entry_schema).json(path)
                .select("*", F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b")).alias("__block"))
                .withColumn("__at", F.monotonically_increasing_id()))
    return _positions(rows).drop("__block", "__at")


def _positions(rows: DataFrame) -> DataFrame:
    """``list_pos`` of rows that carry their block (``__block``, in file order) and a rising number in it (``__at``, without gaps). The
    rows are written first, so that their numbers and the counts of the blocks agree; each block adds the counts of those before it. What
    meets in one task is one row per block."""
    placed = written(rows, "page-list")
    blocks = placed.groupBy("__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = F.sum("__n").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    shifts = blocks.select("__block", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    return placed.join(shifts, "__block").withColumn("list_pos", F.col("__at") + F.col("__shift")).drop("__shift")


def read_managed_list(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """(list_pos, id, name, social_type, managed) in file order."""
    return _entries(spark, path, MANAGED_LIST, MANAGED_ENTRY, multiline).select(
        "list_pos", F.col("id").cast("int").alias("id"), "name", "social_type", "managed")


def read_unmanaged_list(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """(list_pos, id): the id is ``page.id`` when a page object is given, else ``id``. An entry
    with neither is kept with a NULL id; ``list_entries`` reports it."""
    e = _entries(spark, path, UNMANAGED_LIST, UNMANAGED_ENTRY, multiline)
    page_id = F.when(F.col("page").isNotNull(), F.col("page.id")).otherwise(F.col("id"))
    return e.select("list_pos", page_id.cast("int").alias("id"))


def list_entries(managed: DataFrame, unmanaged: DataFrame) -> DataFrame:
    """Both lists as one fetch order: (source, source_rank, list_pos, page_id)."""
    def tag(df: DataFrame, source: str) -> DataFrame:
        return df.select(F.lit(source).alias("source"), F.lit(SOURCE_RANK[source]).alias("source_rank"),
                         F.col("list_pos").cast("bigint").alias("list_pos"), F.col("id").alias("page_id"))
    return tag(managed, MANAGED).unionByName(tag(unmanaged, UNMANAGED))


def without_response(entries: DataFrame, landed: DataFrame) -> DataFrame:
    """Listed pages (entries with an id) for which no response landed."""
    keys = ["source", "page_id"]
    return entries.where(F.col("page_id").isNotNull()).join(landed.select(*keys), keys, "left_anti")


def invalid_entries(entries: DataFrame) -> DataFrame:
    """List entries without a page id. The loader reads the id outside its error handling, so
    such an entry stops the whole run there; here they are reported and the rest proceeds."""
    return entries.where(F.col("page_id").isNull())
