"""Constraints of the target schema, run as queries that return the offending rows.

Spark does not enforce keys, so each constraint becomes a data-quality job:
``duplicate_keys`` (primary key), ``unique_violations`` (UNIQUE, NULLs never clash),
``orphans`` (foreign key), ``bad_json`` / ``bad_ints`` (text the database would refuse to cast).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import is_one_object


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Primary-key violations: key values held by more than one row, or containing NULL."""
    keys = list(keys)
    any_null = reduce(or_, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(count_col))
              .where((F.col(count_col) > 1) | any_null))


def unique_violations(df: DataFrame, cols: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """UNIQUE violations: value combinations held by several rows; rows with a NULL never clash."""
    cols = list(cols)
    no_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return (df.where(no_null).groupBy(*cols).agg(F.count(F.lit(1)).cast("bigint").alias(count_col))
              .where(F.col(count_col) > 1))


def orphans(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str] | None = None) -> DataFrame:
    """Foreign-key violations: child rows whose non-NULL key has no parent row."""
    fk = list(fk)
    pk = list(pk or fk)
    # no DISTINCT: an anti join only tests existence, duplicates in the parent change nothing
    parent_keys = parent.select(*[F.col(p).alias(f) for p, f in zip(pk, fk)])
    no_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk])
    return child.where(no_null).join(parent_keys, fk, "left_anti")


def orphans_dense(child: DataFrame, fk: str, parent: DataFrame, pk: str | None = None) -> DataFrame:
    """``orphans`` for one integer key, decided by bitmaps: the same rows, without moving the child rows that have a parent.

    The keys of both sides become bitmaps of 32,768 keys each; a task reports one bitmap per bucket it meets, not its rows.
    A bucket in which both sides together have more keys than the parent alone holds orphans. Child rows of the other buckets
    go no further; in these the bit of their key tells. Meant for keys that lie close together (surrogate ids): a bitmap
    of one key is as large as one of many."""
    pk = pk or fk

    def bits(df: DataFrame, col: str) -> DataFrame:
        if dict(df.dtypes)[col] not in ("tinyint", "smallint", "int", "bigint"):
            raise ValueError(f"{col} is no integer key")
        key = F.col(col).cast("bigint")
        return (df.where(F.col(col).isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("__bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("__bits")))
    both = bits(parent, pk).withColumn("__own", F.lit(True)).unionByName(bits(child, fk).withColumn("__own", F.lit(False)))
    held = F.max(F.when(F.col("__own"), F.col("__bits")))                    # at most one row of the parent per bucket
    open_ = (both.groupBy("__bucket").agg(F.bitmap_count(F.bitmap_or_agg("__bits")).alias("__all"), held.alias("__held"))
             .where(F.col("__all") > F.coalesce(F.bitmap_count("__held"), F.lit(0))).select("__bucket", "__held"))
    key = F.col(fk).cast("bigint")
    at = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring("__held", F.expr("__at div 8 + 1"), F.lit(1))), 16, 10).cast("int")
    unset = F.expr("shiftright(__byte, cast(__at % 8 as int)) & 1") == 0
    tested = (child.where(F.col(fk).isNotNull()).withColumn("__bucket", F.bitmap_bucket_number(key)).withColumn("__at", at)
              .join(open_, "__bucket").withColumn("__byte", byte))
    return tested.where(F.col("__held").isNull() | unset).select(*child.columns)


NOT_ONE_OBJECT = "not one JSON object"


def bad_json(df: DataFrame, text: Column, keep: Sequence[str], reason_col: str = "reason") -> DataFrame:
    """Rows whose (repaired) text a strict parser refuses as a JSON object: cut or unparsable
    text, text after the object, several objects, an array."""
    return (df.select(*keep, text.alias("text")).where(~is_one_object(F.col("text")))
              .withColumn(reason_col, F.lit(NOT_ONE_OBJECT)))


def bad_ints(df: DataFrame, text: Column, keep: Sequence[str]) -> DataFrame:
    """Rows whose non-NULL text is not an integer (the strict cast would fail)."""
    return df.select(*keep, text.alias("text")).where(F.col("text").isNotNull() & F.col("text").try_cast("int").isNull())
