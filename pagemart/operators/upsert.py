"""Keyed write semantics of the target database, as aggregations.

All three are one ``groupBy(key)`` with ``min_by`` / ``max_by``: Spark plans a sort aggregate (the
values are structs) with a map-side partial step, so a hot key collapses to one row per map task
before the shuffle (no whole group is ever held by one task, unlike ``row_number`` over a window).

- ``insert_ignore``      INSERT ... ON CONFLICT DO NOTHING: first row per key wins, an existing
                         target row is kept.
- ``insert_or_replace``  INSERT ... ON CONFLICT DO UPDATE SET every column = EXCLUDED: the new row
                         replaces the stored one.
- ``upsert_partial``     record-driven upsert: each record sets only the keys it carries, the
                         last record per key and column wins, an explicit null overwrites.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import written_at
from .quality import unique_violations

BROADCAST_KEYS = 2_000_000      # one number each
_ROW = "__row"
_SRC = "__src"
_PRESENT = "__present"
_SEQ, _VALUE = "seq", "value"


def _order(cols: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` (which must be total within a
    key, else the survivor is arbitrary). Output keeps ``df``'s columns and order."""
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.dropDuplicates(keys)
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), _order(order)).alias(_ROW))
    return picked.select(*keys, f"{_ROW}.*").select(*df.columns)


def insert_ignore(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  target: DataFrame | None = None) -> DataFrame:
    """Target after ``INSERT rows ON CONFLICT (keys) DO NOTHING``. ``order`` states which of
    several new rows with one key comes first (the statement's own row order)."""
    if target is None:
        return first_wins(rows, keys, order)
    new = rows.withColumn(_SRC, F.struct(F.lit(1).alias("layer"), _order(order).alias("pos")))
    pos_type = new.schema[_SRC].dataType["pos"].dataType
    old = target.select(*rows.columns).withColumn(
        _SRC, F.struct(F.lit(0).alias("layer"), F.lit(None).cast(pos_type).alias("pos")))
    return first_wins(old.unionByName(new), keys, [_SRC]).drop(_SRC)


DUPLICATE_KEY = "DUPLICATE_KEY_IN_BATCH"    # what the error of a strict ``insert_or_replace`` starts with


def insert_or_replace(rows: DataFrame, keys: Sequence[str], target: DataFrame | None = None,
                      strict: bool = False, table: str = "rows") -> DataFrame:
    """Target after ``INSERT rows ON CONFLICT (keys) DO UPDATE`` of all columns. ``rows`` must be
    unique on ``keys``: the database rejects a batch touching one key twice. ``strict=True`` asserts
    that in the aggregation that merges, so the job that uses the result fails, naming ``table`` and the
    key; no job of its own is run. Otherwise one row of a repeated key is taken."""
    keys = list(keys)
    if target is None and not strict:
        return rows
    both = rows.withColumn(_SRC, F.lit(0))
    if target is not None:
        both = both.unionByName(target.select(*rows.columns).withColumn(_SRC, F.lit(1)))
    if not strict:
        return first_wins(both, keys, [_SRC]).drop(_SRC)
    payload = [c for c in rows.columns if c not in keys]
    picked = both.groupBy(*keys).agg(F.min_by(F.struct(F.col(_SRC), *payload), _SRC).alias(_ROW), F.count_if(F.col(_SRC) == 0).alias("__n"))
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys])
    error = F.raise_error(F.concat(F.lit(f"{DUPLICATE_KEY}: {table} sets "), shown, F.lit(" "), F.col("__n"), F.lit(" times")))
    # a filter, which no column pruning leaves out
    once = picked.where(F.when(F.col("__n") > 1, error.cast("boolean")).otherwise(F.lit(True)))
    return once.select(*keys, f"{_ROW}.*").select(*rows.columns)


def upsert_partial(records: DataFrame, keys: Sequence[str], seq: Sequence[str | Column], present: str,
                   columns: Sequence[str], target: DataFrame | None = None, order_col: str | None = None) -> DataFrame:
    """Record-driven upsert. ``records`` carry ``present`` (array of the column names the record
    holds) and a total order ``seq``. Per key and column the value of the last record that holds
    the column wins, even when that value is NULL; a column no record holds keeps the target's
    value (NULL for a new key).

    A ``target`` row counts as older than every record. With ``order_col`` the result also holds, per
    key, the order of the record each column's value comes from (an array of orders, each with its columns); a target
    with that column competes by it, so any split of the same records into batches gives the same rows."""
    keys, columns = list(keys), list(columns)
    recs = records.select(*keys, *columns, F.col(present).alias(_PRESENT), _order([F.lit(1), *seq]).alias(_SRC))
    if target is not None:
        if order_col is not None and order_col in target.columns:
            base = _as_records(target, keys, columns, order_col)
        else:
            seq_type = recs.schema[_SRC].dataType
            first = F.struct(F.lit(0).alias(seq_type.fields[0].name),
                             *[F.lit(None).cast(f.dataType).alias(f.name) for f in seq_type.fields[1:]])
            base = target.select(*keys, *columns, F.array(*map(F.lit, columns)).alias(_PRESENT), first.alias(_SRC))
        recs = base.unionByName(recs)
    return _latest_per_column(recs, keys, columns, order_col)


def only_records(records: DataFrame, keys: Sequence[str], seq: Sequence[str | Column], present: str, columns: Sequence[str],
                 order_col: str) -> DataFrame:
    """``upsert_partial`` of records that are the only ones of their keys: they are the rows, so nothing is shuffled or aggregated.
    ``present`` has to name keys and columns only, each once, and a record to be NULL in the columns it does not hold."""
    held = reduce(lambda names, k: F.array_remove(names, F.lit(k)), keys, F.col(present))
    order = F.struct(_order([F.lit(1), *seq]).alias("seq"), held.alias("columns"))
    return records.select(*keys, *columns, F.when(F.size(held) > 0, F.array(order)).otherwise(F.array()).alias(order_col))


def _as_records(rows: DataFrame, keys: list[str], columns: list[str], order_col: str) -> DataFrame:
    """Rows with ``order_col`` as the records their values come from: one per order, which holds that order's columns."""
    return (rows.select(*keys, *columns, F.explode_outer(order_col).alias(_SRC))
            .select(*keys, *columns, F.col(f"{_SRC}.columns").alias(_PRESENT), F.col(f"{_SRC}.seq").alias(_SRC)))


def _latest_per_column(recs: DataFrame, keys: list[str], columns: list[str], order_col: str | None) -> DataFrame:
    order = {c: f"CASE WHEN array_contains({_PRESENT}, '{c}') THEN {_SRC} END" for c in columns}
    # one SQL expression per column (a Column built node by node costs a driver round trip per node)
    if order_col is None:
        return recs.groupBy(*keys).agg(*[F.expr(f"max_by(`{c}`, {o})").alias(c) for c, o in order.items()])
    # the value with its order: one aggregate per column finds both
    latest = recs.groupBy(*keys).agg(*[F.expr(f"max_by(named_struct('{_SEQ}', {_SRC}, '{_VALUE}', `{c}`), {o})").alias(c) for c, o in order.items()])
    found = "filter(array(" + ", ".join(f"named_struct('c', '{c}', 'seq', `{c}`.{_SEQ})" for c in columns) + "), e -> e.seq IS NOT NULL)"
    grouped = latest.select(*keys, *[F.col(f"`{c}`.{_VALUE}").alias(c) for c in columns], F.expr(found).alias(order_col))
    runs = (f"transform(array_distinct(transform(`{order_col}`, e -> e.seq)), s -> named_struct('seq', s, "
            f"'columns', transform(filter(`{order_col}`, e -> e.seq = s), e -> e.c)))")
    return grouped.withColumn(order_col, F.expr(runs))


def repeated_keys(rows: DataFrame, key: str) -> tuple[DataFrame, str]:
    """Values of ``key`` that more than one of ``rows`` has, written, and their folder. It reads the key alone; a join with them
    moves rows only if there are too many such values for a broadcast."""
    keys, path = written_at(unique_violations(rows, [key]).select(key), "repeated")
    return (F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys), path


def merge_tracked(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], order_col: str) -> DataFrame:
    """One row per key from rows that ``upsert_partial`` made with ``order_col``: per column the value of the row with the highest
    order for it, null included; a column no row has an order for is NULL. Merging is associative and does not depend on
    the order of the rows. The only row of a key is left as it is."""
    keys, columns = list(keys), list(columns)
    return _latest_per_column(_as_records(rows, keys, columns, order_col), keys, columns, order_col)
