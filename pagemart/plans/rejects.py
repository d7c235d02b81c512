"""What a refresh cannot load as it stands, one row per value: (target, row_id, field, text, reason).

The load of the reference stops (or drops a row) on such values; the refresh goes on and reports them, or stops
with ``strict``. Every check is decided inside the row that holds the text: no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import has_json, json_fields
from ..functions.jsontext import is_one_object
from ..functions.text import blank_to_null
from ..operators import json_members
from ..operators.explode import first_heads
from ..operators.quality import NOT_ONE_OBJECT
from .dw import CLICK_FIELDS
from .ods import FAN_KINDS, VIDEO_FIELDS

NOT_AN_INTEGER, BLANK_LABEL, LABEL_COLLIDES = "not an integer", "blank label", "label collides after trim"


class RejectedRows(RuntimeError):
    """A strict refresh met values it cannot load."""


def _row(target: Column, row_id: Column, field: Column, text: Column, reason: Column) -> list[Column]:
    return [target.alias("target"), row_id.cast("bigint").alias("row_id"), field.alias("field"), text.alias("text"), reason.alias("reason")]


def label_problems(members: Column) -> Column:
    """Members of a (first-wins) ``json_members`` array whose label the cleaning pass drops, with the reason."""
    label = lambda m: blank_to_null(m["k"])
    earlier = lambda m: F.exists(members, lambda o: (o["p"] < m["p"]) & (label(o) == label(m)))
    marked = F.transform(members, lambda m: F.struct(
        m["k"].alias("k"), F.when(label(m).isNull(), F.lit(BLANK_LABEL)).when(earlier(m), F.lit(LABEL_COLLIDES)).alias("reason")))
    return F.filter(marked, lambda m: m["reason"].isNotNull())


def fan_rejects(insights: DataFrame) -> DataFrame:
    """Fan maps that are not one object, values that are no integers, labels that cleaning drops."""
    kinds = F.array(*[F.struct(F.lit(f"ods_fans_{k}").alias("target"), F.when(has_json(F.col(c)), fix(F.col(c))).alias("text"))
                      for k, (c, _, fix) in FAN_KINDS.items()])
    maps = insights.select(F.col("insight_id").alias("id"), F.explode(kinds).alias("m")).select("id", "m.*").where("text IS NOT NULL")
    parsed = maps.withColumn("sorted", json_members(F.col("text"))).withColumn("members", first_heads(F.col("sorted")))
    whole = F.when(~is_one_object(F.col("text")), F.array(F.struct(
        F.lit(None).cast("string").alias("field"), F.col("text").alias("text"), F.lit(NOT_ONE_OBJECT).alias("reason"))))
    ints = F.transform(F.filter("members", lambda m: m["v"].isNotNull() & m["v"].try_cast("int").isNull()), lambda m: F.struct(
        m["k"].alias("field"), m["v"].alias("text"), F.lit(NOT_AN_INTEGER).alias("reason")))
    labels = F.transform(label_problems(F.col("members")), lambda m: F.struct(
        m["k"].alias("field"), F.lit(None).cast("string").alias("text"), m["reason"].alias("reason")))
    found = F.when(F.col("members").isNull(), whole).otherwise(F.concat(ints, labels))
    out = parsed.select("target", "id", F.explode(found).alias("r"))
    return out.select(*_row(F.col("target"), F.col("id"), F.col("r.field"), F.col("r.text"), F.col("r.reason")))


def _field_rejects(posts: DataFrame, target: str, column: str, fields: list[str], under: str | None) -> DataFrame:
    values = F.array(*[F.struct(F.lit(f).alias("field"), F.col("v")[f].alias("text")) for f in fields])
    bad = F.transform(F.filter("values", lambda m: m["text"].try_cast("int").isNull() & m["text"].isNotNull()),
                      lambda m: F.struct(m["field"], m["text"], F.lit(NOT_AN_INTEGER).alias("reason")))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.col("text"), F.lit(NOT_ONE_OBJECT).alias("reason")))
    rows = posts.where(has_json(F.col(column))).select("id", F.col(column).alias("text"), json_fields(F.col(column), fields, under).alias("v"))
    found = rows.select("id", "text", is_one_object(F.col("text")).alias("ok"), values.alias("values"))
    out = found.select("id", F.explode(F.when(F.col("ok"), bad).otherwise(whole)).alias("r"))
    return out.select(*_row(F.lit(target), F.col("id"), F.col("r.field"), F.col("r.text"), F.col("r.reason")))


def refresh_rejects(stg_posts: DataFrame, insights: DataFrame, carry_clicks: bool = False) -> DataFrame:
    """All rejects of a refresh from the staged posts and the eligible insights (``ods.ods_insights``)."""
    parts = [fan_rejects(insights), _field_rejects(stg_posts, "ods_data_video", "data", list(VIDEO_FIELDS), "data")]
    if carry_clicks:
        parts.append(_field_rejects(stg_posts, "fact_posts", "post_clicks_by_type", [k for k, _ in CLICK_FIELDS], None))
    return reduce(DataFrame.unionByName, parts)
