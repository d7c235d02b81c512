"""Surrogate keys without a global single-task window.

- ``date_key``        the date dimension is a gap-free day series, so its key is arithmetic:
                      ``days since start + 1``; facts compute it instead of joining the dim.
- ``sequential_ids``  dense 1..n in the order of a natural key (label dims), in one lazy plan: rows are
                      ranked within ranges of the key, and each range adds the row count of those before it.
- ``continued_ids``   dense ids that outlive a run: a registry in which known keys keep their id and new
                      ones are appended.
- ``dense_ids``       dense 1..n for fact tables (a SERIAL filled by one statement): numbered in key
                      ranges that are written first, counted from the file.
- ``unique_ids``      unique, increasing per partition, not dense, without a shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written

_BUCKET, _BEFORE, _CUTS = "__b", "__before", "__cuts"
RANGES = 256  # key ranges that ids are ranked in


def date_key(d: Column, start: dt.date, end: dt.date | None = None) -> Column:
    """Key of ``d`` in a day series ``start..end`` (``end=None``: open ended); NULL outside."""
    inside = d >= F.lit(start)
    if end is not None:
        inside = inside & (d <= F.lit(end))
    return F.when(inside, F.datediff(d, F.lit(start)) + F.lit(1))


def _drawn_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with the number of the key range each row falls in. The ranges are cut at keys drawn from the table by their hash,
    so they hold about the same number of rows however alike the keys begin; the drawing has a fixed size and is one row."""
    key = F.struct(*order)
    cuts = (df.select(key.alias("k")).orderBy(F.xxhash64(*order), "k").limit(RANGES - 1)
            .agg(F.sort_array(F.collect_list("k")).alias(_CUTS)))
    steps = ", ".join(str(2 ** e) for e in range((RANGES - 1).bit_length() - 1, -1, -1))
    fields = ", ".join(f"'{c}', `{c}`" for c in order)
    # how many cuts are not above the key, by halving
    place = f"""aggregate(array({steps}), 0, (n, s) ->
        CASE WHEN n + s <= size({_CUTS}) AND try_element_at({_CUTS}, n + s) <= named_struct({fields}) THEN n + s ELSE n END)"""
    return df.crossJoin(F.broadcast(cuts)).withColumn(_BUCKET, F.coalesce(F.expr(place), F.lit(0))).drop(_CUTS)


def sequential_ids(df: DataFrame, order: Sequence[str], id_col: str, start: int = 1) -> DataFrame:
    """Add ``id_col`` = ``start``-based rank of each row in ``order`` (which must be unique per
    row, e.g. the natural key of a dimension; NULL comes first, as in an ascending sort).

    Rows are ranked inside ranges of the whole key (see ``_drawn_ranges``), and each range adds the row count of those before
    it; only the counts, one small row per range, meet in one task. Range and rank follow from the rows alone, so a
    recomputed partition gives the same ids."""
    dealt = _drawn_ranges(df, order)
    counts = dealt.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(_BUCKET, F.coalesce(before, F.lit(0)).alias(_BEFORE))
    rank = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*order))
    return (dealt.withColumn("__rank", rank).join(offsets, _BUCKET)
            .select(*df.columns, (F.col(_BEFORE) + F.col("__rank") + F.lit(start - 1)).cast("int").alias(id_col)))


def continued_ids(labels: DataFrame, key: Sequence[str], id_col: str, known: DataFrame | None = None) -> DataFrame:
    """The key registry after ``labels`` (one row per key) were seen: a key of the registry ``known`` (key columns and
    ``id_col``) keeps its id, also if it is not among ``labels`` now; the others get the ids after the highest, in key order.
    A NULL is a key value like others."""
    key = list(key)
    if known is None:
        return sequential_ids(labels.select(*key), key, id_col)
    known = known.select(*key, F.col(id_col).cast("int").alias(id_col))
    old = known.select(*[F.col(c).alias(f"__{c}") for c in key])
    fresh = labels.select(*key).join(old, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]), "left_anti")
    top = known.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__top"))         # one row
    added = sequential_ids(fresh, key, "__rank").crossJoin(F.broadcast(top))
    return known.unionByName(added.select(*key, (F.col("__top") + F.col("__rank")).cast("int").alias(id_col)))


def dense_ids(df: DataFrame, order: Sequence[str], id_col: str, start: int = 1) -> DataFrame:
    """Add ``id_col`` = ``start``-based rank (BIGINT) in ``order``, then by the other columns, for tables of any size.

    Two passes over a file: the rows are written in key ranges, each range sorted and its rows numbered; the counts of
    the ranges are read from what was written, so they agree with it whatever is recomputed later, and each range adds
    those before it. Rows alike in all columns are interchangeable."""
    ties = [c for c, t in df.dtypes if c not in order and not t.startswith(("map", "variant"))]
    by = [*order, *ties]
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(dealt.withColumn(_BUCKET, F.spark_partition_id())
                     .withColumn("__at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "dense-ids")
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)          # one row per range
    counts = placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    offsets = counts.select(_BUCKET, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias(_BEFORE))
    return placed.join(offsets, _BUCKET).select(*df.columns, (F.col("__at") + F.col(_BEFORE) + F.lit(start)).alias(id_col))


def unique_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Add a unique BIGINT id without a shuffle (partition id in the high bits)."""
    return df.withColumn(id_col, F.monotonically_increasing_id())
