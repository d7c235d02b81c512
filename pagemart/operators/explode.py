"""Lateral JSON object explode: one output row per member of a JSON object held as text.

The first occurrence of a repeated key wins (the fan tables are keyed on (insight, label) and
the load keeps the first row). That choice is made *inside the row*: the members are sorted by
(key, position) in one projection and only the head of each key run is kept in the next.
Duplicates can only come from one object, so no shuffle is needed, and a hot label costs nothing
extra.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsontext import json_entries

_MEMBERS = "__members"


def json_members(json_text: Column, key_fn: Callable[[Column], Column] | None = None,
                 drop_null_keys: bool = False, sort: bool = True) -> Column:
    """``array<struct<k, p, v>>``: key (after ``key_fn``), position in the object, value text;
    sorted by (key, position) when ``sort`` (the input of ``first_heads``)."""
    key_fn = key_fn or (lambda k: k)
    members = F.transform(json_entries(json_text),
                          lambda e, i: F.struct(key_fn(e["key"]).alias("k"), i.alias("p"), e["value"].alias("v")))
    if drop_null_keys:
        members = F.filter(members, lambda m: m["k"].isNotNull())
    return F.array_sort(members) if sort else members  # struct order: key, then position


def first_heads(ordered: Column) -> Column:
    """Keep the first member of each key run of a ``json_members`` array (lowest position).

    ``ordered`` must be an already computed column: it is read three times here, and Spark does
    not share repeated sub-expressions under array lambdas, so passing the expression itself
    would parse and sort the JSON three times per row."""
    # previous element's key, with a marker for "no previous element" at the head
    prev = F.concat(F.array(F.struct(F.lit(False).alias("has"), F.lit(None).cast("string").alias("k"))),
                    F.transform(F.slice(ordered, 1, F.greatest(F.size(ordered) - 1, F.lit(0))),
                                lambda m: F.struct(F.lit(True).alias("has"), m["k"].alias("k"))))
    heads = F.zip_with(ordered, prev,
                       lambda m, p: F.when(~p["has"] | ~m["k"].eqNullSafe(p["k"]), m))
    return F.filter(heads, lambda m: m.isNotNull())


def explode_json_object(df: DataFrame, json_text: Column, keep: Sequence[str], key_name: str,
                        value_name: str = "value", pos_name: str | None = None,
                        key_fn: Callable[[Column], Column] | None = None, first_wins: bool = True,
                        drop_null_keys: bool = False) -> DataFrame:
    """Rows of ``df`` times members of the JSON object in ``json_text``. NULL or unparsable text
    gives no row. Output: ``keep`` columns, ``key_name``, ``value_name`` (text), optionally the
    member position."""
    staged = df.select(*keep, json_members(json_text, key_fn, drop_null_keys, sort=first_wins).alias(_MEMBERS))
    members = first_heads(F.col(_MEMBERS)) if first_wins else F.col(_MEMBERS)
    exploded = staged.select(*keep, F.explode(members).alias(_MEMBERS))
    out = [*keep, F.col(f"{_MEMBERS}.k").alias(key_name), F.col(f"{_MEMBERS}.v").alias(value_name)]
    if pos_name:
        out.append(F.col(f"{_MEMBERS}.p").alias(pos_name))
    return exploded.select(*out)
