"""Named queries over the test tables: one per operator / job of the inventory.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables. ``pagemart.oracle`` holds
the DuckDB SQL of the same name. Surrogate ids that depend on execution order (the
demographics ``fact_id``) are left out of the compared output; label ids are dense in label
order and are compared.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import (blank_to_null, has_json, initcap_words, locale_braces, platform_ok, post_type,
                        reactions_total, simple_braces, strip_nul)
from .functions.posts import clean_post_type
from .operators import (bad_ints, bad_json, duplicate_keys, insert_ignore, insert_or_replace, orphans, orphans_dense, unique_violations,
                        upsert_partial)
from .plans import clean, constraints, dw, ods, rejects
from .session import ensure_checkpoint_dir
from .sources import testdata
from .storage import written


class Layers:
    """Lazily built staging, ODS and DW DataFrames of one test scale. Shared intermediate
    DataFrames are built once per instance so size checks run once."""

    def __init__(self, spark: SparkSession, sf_dir: str, start: dt.date = dw.DATE_START):
        self.spark, self.sf_dir, self.start = spark, sf_dir, start
        self.stg = testdata.Staging(spark, sf_dir)

    @cached_property
    def pages(self) -> DataFrame:
        return ods.eligible_pages(self.stg.clients, self.stg.unmanaged_clients)

    def days(self) -> DataFrame:
        """Every post and insight day of the data (the date dimension runs through the last)."""
        return (self.stg.posts.select(F.to_date("creation_time").alias("d"))
                .unionByName(self.stg.insights.select(F.col("day").alias("d"))))

    def ods_clients(self) -> DataFrame:
        return ods.ods_clients(self.stg.clients, self.stg.unmanaged_clients)

    def ods_posts(self, strict_deleted: bool = False, keep_payload: bool = False) -> DataFrame:
        return ods.ods_posts(self.stg.posts, self.pages, strict_deleted=strict_deleted, keep_payload=keep_payload)

    @cached_property
    def ods_insights(self) -> DataFrame:
        return ods.ods_insights(self.stg.insights, self.pages)

    def fans(self, kind: str) -> DataFrame:
        return ods.ods_fans(self.ods_insights, kind)

    @cached_property
    def clean_fan_rows(self) -> DataFrame:
        return ods.fan_entries(self.ods_insights, clean=True)

    def video(self) -> DataFrame:
        return ods.ods_data_video(self.stg.posts, with_load_time=False)

    def clean_posts(self, keep_payload: bool = False) -> DataFrame:
        return clean.clean_posts(self.ods_posts(keep_payload=keep_payload))

    def clean_clients(self) -> DataFrame:
        return clean.clean_clients(self.ods_clients())

    def clean_insights(self) -> DataFrame:
        return clean.clean_insights(self.ods_insights)

    def dim_date(self) -> DataFrame:
        return dw.dim_date_through(self.days(), self.start)

    @cached_property
    def dim_post_type(self) -> DataFrame:
        return dw.dim_post_type(self.clean_posts())

    @cached_property
    def dim_location(self) -> DataFrame:
        return dw.dim_location(self.clean_fan_rows)

    # Facts: the date dimension runs through the data's last day, so only the lower bound of
    # the series can put a fact outside it (end=None).
    def fact_posts(self) -> DataFrame:
        return dw.fact_posts(self.clean_posts(keep_payload=True), self.dim_post_type, None, self.start)

    def fact_posts_with_clicks(self) -> DataFrame:
        """The click map carried along, and the video table joined back on post_id (the load's own join)."""
        posts = clean.clean_posts(ods.ods_posts(self.stg.posts, self.pages, carry_clicks=True))
        return dw.fact_posts(posts, self.dim_post_type, self.video(), self.start)

    def key_tables(self) -> dict[str, DataFrame]:
        """Every table that declares a key. What several of them come from is written first, so that it is built once; the rest
        reads key columns only."""
        self.pages = written(self.pages, "keys-pages")
        self.clean_fan_rows = fans = written(self.clean_fan_rows, "keys-fans")
        self.dim_location = written(self.dim_location, "keys-locations")
        posts = written(self.clean_posts(), "keys-posts").withColumn("data", F.lit(None).cast("string"))    # the payload holds no key
        clients = written(self.clean_clients(), "keys-clients")
        types = written(dw.dim_post_type(posts), "keys-post-types")
        per_kind = {f"ods_fans_{kind}": fans.where(F.col("location_type") == kind)
                    .select("insight_id", "client_id", F.col("location_label").alias(label)) for kind, (_, label, _) in ods.FAN_KINDS.items()}
        return {"stg_clients": self.stg.clients, "stg_unmanaged_clients": self.stg.unmanaged_clients, "stg_posts": self.stg.posts,
                "stg_insights": self.stg.insights, "ods_clients": clients, "ods_posts": posts, "ods_insights": self.ods_insights,
                "ods_data_video": self.video(), **per_kind, "dim_date": self.dim_date(), "dim_client": dw.dim_client(clients),
                "dim_post_type": types, "dim_location": self.dim_location, "fact_posts": dw.fact_posts(posts, types, None, self.start),
                "fact_insights": self.fact_insights(),
                "fact_fan_demographics": dw.fact_fan_demographics(fans, self.dim_location, self.start)}

    def fact_insights(self) -> DataFrame:
        return dw.fact_insights(self.clean_insights(), self.start)

    def fact_fan_demographics(self) -> DataFrame:
        return dw.fact_fan_demographics(self.clean_fan_rows, self.dim_location, self.start, with_fact_id=False)


def _both_client_lists(L: Layers) -> DataFrame:
    return (L.stg.clients.withColumn("list", F.lit("managed"))
            .unionByName(L.stg.unmanaged_clients.withColumn("list", F.lit("unmanaged"))))


# ---- lineitem as a keyed record stream (upsert / insert operators) --------------------------
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_SEQ = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]
LINE_OUT = [*LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.read_table(spark, sf_dir, "lineitem")


def q_upsert_partial(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    recs = li.select(*LINE_KEY, *LINE_SEQ,
                     F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
                     F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("tax"),
                     F.when(F.col("l_returnflag") != "N", F.array(*map(F.lit, ["qty", "price", "tax"])))
                      .otherwise(F.array(*map(F.lit, ["qty", "price"]))).alias("present"))
    return upsert_partial(recs, LINE_KEY, LINE_SEQ, "present", ["qty", "price", "tax"])


def q_insert_ignore(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    return insert_ignore(li.select(*LINE_OUT, *[c for c in LINE_SEQ if c not in LINE_OUT]), LINE_KEY, LINE_SEQ) \
        .select(*LINE_OUT)


def q_insert_or_replace(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    cols = [*LINE_OUT, *[c for c in LINE_SEQ if c not in LINE_OUT]]
    target = insert_ignore(li.where(F.col("l_linestatus") == "F").select(*cols), LINE_KEY, LINE_SEQ).select(*LINE_OUT)
    new = insert_ignore(li.where(F.col("l_linestatus") == "O").select(*cols), LINE_KEY, LINE_SEQ).select(*LINE_OUT)
    return insert_or_replace(new, LINE_KEY, target)


def _old_and_new_lines(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    cols = [*LINE_OUT, *[c for c in LINE_SEQ if c not in LINE_OUT]]
    old = insert_ignore(li.where(F.col("l_linestatus") == "F").select(*cols), LINE_KEY, LINE_SEQ).select(*LINE_OUT)
    return old, li.where((F.col("l_linestatus") == "O") | (F.col("l_partkey") % 3 == 0)), cols


def q_insert_ignore_target(spark, sf_dir):
    old, new, cols = _old_and_new_lines(spark, sf_dir)
    new = insert_ignore(new.select(*cols), LINE_KEY, LINE_SEQ).select(*LINE_OUT)
    return insert_ignore(new, LINE_KEY, ["l_shipdate"], old)


def q_upsert_partial_target(spark, sf_dir):
    old, new, _ = _old_and_new_lines(spark, sf_dir)
    seq = [F.col(c).alias(f"s_{c}") for c in LINE_SEQ]
    recs = new.select(*LINE_KEY, *seq, "l_quantity", F.when(F.col("l_tax") != 0, F.col("l_suppkey")).alias("l_suppkey"),
                      F.when(F.col("l_returnflag") != "N", F.array(F.lit("l_quantity"), F.lit("l_suppkey")))
                       .otherwise(F.array(F.lit("l_quantity"))).alias("present"))
    return upsert_partial(recs, LINE_KEY, [f"s_{c}" for c in LINE_SEQ], "present", ["l_quantity", "l_suppkey"], old)


def q_check_pk(spark, sf_dir):
    return duplicate_keys(_lineitem(spark, sf_dir), LINE_KEY)


# ---- ingestion: landed responses built from the tables -> staging ----------------------

# sf_dir -> folder of already landed responses (the bench lands them before it measures)
LANDED: dict[str, str] = {}


def _ingested(spark: SparkSession, sf_dir: str):
    from .sources import landing, responses
    landed = LANDED.get(sf_dir)
    return responses.ingest(spark.read.parquet(landed) if landed else landing.landed_responses(spark, sf_dir))


def _staged_as_adapter(table: str, adapter) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cols = adapter(spark, sf_dir).columns
        return getattr(_ingested(spark, sf_dir), table).select(*cols)
    run.__name__ = f"ingest_{table}"
    return run


def _staged_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts table of the landed responses when they are staged in three batches, as deltas, and a third of the buckets is
    compacted between."""
    from .sources import landing
    from .streaming.deltas import DeltaStore
    from .streaming.ingest import stage_batch
    at = LANDED.get(sf_dir)
    landed = spark.read.parquet(at) if at else written(landing.landed_responses(spark, sf_dir), "landed")
    root = f"{ensure_checkpoint_dir(spark)}/deltas-{uuid.uuid4().hex}"
    for i in range(3):
        stage_batch(spark, landed.where(F.pmod(F.xxhash64("page_id", "chunk"), F.lit(3)) == i), root, i)
        if i == 1:
            DeltaStore(spark, root).compact(["stg_posts"], range(0, 64, 3))
    return DeltaStore(spark, root).read("stg_posts")


def _keys_over_runs(L: Layers) -> DataFrame:
    """Page names as labels: a first run sees the managed list, a second one both lists, a third only the unmanaged one. Known
    names keep their id, new ones are appended, names that are gone stay registered."""
    managed, unmanaged = (df.select(initcap_words(F.col("name")).alias("label")) for df in (L.stg.clients, L.stg.unmanaged_clients))
    first = written(dw.registered(managed.distinct(), ["label"], "label_id", None), "registry")
    second = written(dw.registered(managed.unionByName(unmanaged).distinct(), ["label"], "label_id", first), "registry")
    return dw.registered(unmanaged.distinct(), ["label"], "label_id", second)


def _unique_values(L: Layers) -> DataFrame:
    """Values a UNIQUE column holds twice: page ids over both lists (there are some), dimension labels (none)."""
    def over(table: str, df: DataFrame, cols: list[str]) -> DataFrame:
        return unique_violations(df, cols).select(F.lit(table).alias("tab"), F.concat_ws("|", *cols).alias("value"), "n_rows")
    return (over("client lists", L.stg.clients.select("id").unionByName(L.stg.unmanaged_clients.select("id")), ["id"])
            .unionByName(over("dim_location", L.dim_location, ["location_type", "location_label"]))
            .unionByName(over("dim_post_type", L.dim_post_type, ["label"]))
            .unionByName(over("dim_date", L.dim_date(), ["full_date"])))


def _fan_texts(L: Layers) -> DataFrame:
    """Fan texts of all three maps that are not one JSON object after repair."""
    texts = F.array(*[F.struct(F.lit(c).alias("field"), F.when(has_json(F.col(c)), fix(F.col(c))).alias("t"))
                      for c, _, fix in ods.FAN_KINDS.values()])
    return bad_json(L.stg.insights.select("id", F.explode(texts).alias("x")).select("id", "x.field", "x.t"), F.col("t"), ["id", "field"])


def _fan_value_ints(L: Layers) -> DataFrame:
    """Fan map values that are not integers (the load's ``value::INT`` would fail); one pass
    over the insights for all three maps."""
    rows = ods.fan_entries(L.ods_insights, with_text=True)
    return bad_ints(rows.withColumnRenamed("location_type", "kind").withColumnRenamed("location_label", "label"),
                    F.col("value_text"), ["kind", "insight_id", "label"])


# ---- registry ----------------------------------------------------------------------------

def _L(fn: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Layers(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # ODS jobs (tables as loaded)
    "ods_clients": _L(lambda L: L.ods_clients()),
    "ods_posts": _L(lambda L: L.ods_posts()),
    "ods_posts_strict": _L(lambda L: L.ods_posts(strict_deleted=True)),
    "ods_insights": _L(lambda L: L.ods_insights),
    "fans_country": _L(lambda L: L.fans("country")),
    "fans_city": _L(lambda L: L.fans("city")),
    "fans_locale": _L(lambda L: L.fans("locale")),
    "data_video": _L(lambda L: L.video()),
    # cleaning pass
    "clean_clients": _L(lambda L: L.clean_clients()),
    "clean_posts": _L(lambda L: L.clean_posts()),
    "clean_insights": _L(lambda L: L.clean_insights()),
    "clean_fans": _L(lambda L: L.clean_fan_rows),
    # star schema
    "dim_date": _L(lambda L: L.dim_date()),
    "dim_date_production": _L(lambda L: dw.dim_date_through(L.days().select(F.make_date(F.year("d"), F.lit(12), F.lit(31)).alias("d")), L.start)),
    "dim_client": _L(lambda L: dw.dim_client(L.clean_clients())),
    "dim_post_type": _L(lambda L: L.dim_post_type),
    "dim_location": _L(lambda L: L.dim_location),
    "fact_posts": _L(lambda L: L.fact_posts()),
    "fact_posts_from_1995": lambda spark, sf_dir: Layers(spark, sf_dir, dt.date(1995, 1, 1)).fact_posts_with_clicks(),
    "fact_insights": _L(lambda L: L.fact_insights()),
    "fact_fan_demographics": _L(lambda L: L.fact_fan_demographics()),
    "fact_fan_demographics_ids": _L(lambda L: dw.fact_fan_demographics(L.clean_fan_rows, L.dim_location, L.start)),
    "keys_over_runs": _L(_keys_over_runs),
    # scalar functions and predicates on whole staging tables
    "initcap_words": _L(lambda L: _both_client_lists(L).select(
        "id", "list", "name", initcap_words(F.col("name")).alias("name_initcap"))),
    "platform_filter": _L(lambda L: _both_client_lists(L).where(platform_ok(F.col("social_type")))
                          .select("id", "list", "social_type")),
    "post_type": _L(lambda L: L.stg.posts.select(
        F.col("id").alias("post_id"), post_type(F.col("type"), F.col("url"), F.col("status_type")).alias("post_type"))),
    "clean_post_type": _L(lambda L: L.stg.posts.select(
        F.col("id").alias("post_id"),
        clean_post_type(post_type(F.col("type"), F.col("url"), F.col("status_type"))).alias("post_type"))),
    "reactions_sum": _L(lambda L: L.stg.posts.select(F.col("id").alias("post_id"), reactions_total().alias("reactions"))),
    "json_text_filter": _L(lambda L: L.stg.insights.select(
        "id", *[has_json(F.col(c)).alias(f"{c}_ok") for c in ("page_fans_country", "page_fans_city", "page_fans_locale")])),
    "clean_text": _L(lambda L: L.stg.posts.select(
        F.col("id").alias("post_id"), blank_to_null(F.col("message")).alias("message"),
        blank_to_null(F.col("is_real")).alias("is_real"))),
    "strip_nul": _L(lambda L: L.stg.posts.select(
        F.col("id").alias("post_id"), strip_nul(F.col("message")).alias("message"), strip_nul(F.col("url")).alias("url"))),
    "post_clicks": _L(lambda L: L.stg.posts.select(F.col("id").alias("post_id"), *dw.click_columns(F.col("post_clicks_by_type")).values())),
    "brace_repair": _L(lambda L: L.stg.insights.select(
        "id", simple_braces(F.col("page_fans_country")).alias("country_text"),
        simple_braces(F.col("page_fans_city")).alias("city_text"),
        locale_braces(F.col("page_fans_locale")).alias("locale_text"))),
    # ingestion of landed responses (accept, split, record-driven upsert, rejects)
    "ingest_clients": _staged_as_adapter("clients", testdata.stg_clients),
    "ingest_unmanaged_clients": _staged_as_adapter("unmanaged_clients", testdata.stg_unmanaged_clients),
    "ingest_insights": _staged_as_adapter("insights", testdata.stg_insights),
    "ingest_posts": _staged_as_adapter("posts", testdata.stg_posts),
    "ingest_posts_deltas": lambda spark, sf_dir: _staged_in_batches(spark, sf_dir).select(*testdata.stg_posts(spark, sf_dir).columns),
    "ingest_rejects": lambda spark, sf_dir: _ingested(spark, sf_dir).rejects.select("source", "page_id", "chunk", "reason"),
    # keyed write semantics on lineitem as a record stream
    "upsert_partial": q_upsert_partial,
    "insert_ignore": q_insert_ignore,
    "insert_or_replace": q_insert_or_replace,
    "insert_ignore_target": q_insert_ignore_target,
    "upsert_partial_target": q_upsert_partial_target,
    # data-quality checks
    "check_pk": q_check_pk,
    "check_unique": _L(_unique_values),
    "check_constraints": _L(lambda L: constraints.violations(L.key_tables())),
    "refresh_rejects": _L(lambda L: rejects.refresh_rejects(L.stg.posts, L.ods_insights, carry_clicks=True)),
    "check_fk": _L(lambda L: orphans(L.video().select("post_id"), ["post_id"], L.ods_posts(), ["post_id"])),
    "check_fk_bitmap": _L(lambda L: orphans_dense(L.video().select("post_id"), "post_id", L.ods_posts(), "post_id")),
    "check_ints": _L(_fan_value_ints),
    "fan_label_rejects": _L(lambda L: rejects.fan_rejects(L.ods_insights)
                            .where(F.col("reason").isin(rejects.BLANK_LABEL, rejects.LABEL_COLLIDES))
                            .select(F.replace("target", F.lit("ods_fans_"), F.lit("")).alias("location_type"),
                                    F.col("row_id").alias("insight_id"), F.col("field").alias("raw_label"), "reason")),
    "check_json": _L(_fan_texts),
}
