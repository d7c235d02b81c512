"""Landed API responses built by Spark from the test tables (the ingest job's input in tests).

Every page of both lists gets responses that carry its client record, its insights (events of
``user_id = page``) and its posts (orders of ``o_custkey = page``), paginated: a page with ``n``
records of its larger kind is split into ``ceil(n / CHUNK)`` responses by ``id mod pages``, so a
response holds about ``CHUNK`` records and none grows with a hot page (the per-page counts are
one small aggregation). Deterministic variations exercise the acceptance and upsert rules:

- managed list (even keys): HTTP 404 when ``page % 23 = 0``; ``"success": false`` when
  ``page % 29 = 0``; otherwise ``"success": true`` and full records;
- unmanaged list (odd keys and multiples of 10): ``"success": 1``; no ``insights`` key when
  ``page % 7 = 0`` (rejected); for pages on both lists the post records are partial
  (``id, page_id, likes, message`` only, ``likes`` an explicit null for even post ids), so the
  staged post keeps the managed values of the absent keys and takes the null.

The SQL of ``pagemart.oracle`` states the same rules for the expected staging tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import testdata

CHUNK = 1024
JSON_OPTS = {"ignoreNullFields": "false"}


def _json(cols) -> Column:
    return F.to_json(F.struct(*cols), JSON_OPTS)


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both page lists: (source, source_rank, list_pos, page_id, page_json)."""
    m = testdata.stg_clients(spark, sf_dir)
    u = testdata.stg_unmanaged_clients(spark, sf_dir)
    return (m.select(F.lit("managed").alias("source"), F.lit(0).alias("source_rank"),
                     F.col("id").cast("bigint").alias("list_pos"), F.col("id").alias("page_id"),
                     _json([F.col(c) for c in m.columns]).alias("page_json"))
            .unionByName(u.select(F.lit("unmanaged").alias("source"), F.lit(1).alias("source_rank"),
                                  F.col("id").cast("bigint").alias("list_pos"), F.col("id").alias("page_id"),
                                  _json([F.col(c) for c in u.columns]).alias("page_json"))))


def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, source_rank, list_pos, page_id, chunk, status, body), one row per response.

    Every chunk of a page gets a row with the page's own JSON, so records and page meet in one aggregation and no body is shuffled."""
    entries = list_entries(spark, sf_dir)
    posts = testdata.stg_posts(spark, sf_dir)
    insights = testdata.stg_insights(spark, sf_dir)
    # responses per page: enough for CHUNK records each of the larger kind (posts or insights)
    # one aggregation over both kinds (no join of two per-page counts)
    per_kind = (posts.select("page_id", F.lit(1).alias("p"), F.lit(0).alias("i"))
                .unionByName(insights.select("page_id", F.lit(0).alias("p"), F.lit(1).alias("i")))
                .groupBy("page_id").agg(F.sum("p").alias("n_posts"), F.sum("i").alias("n_insights")))
    chunks_of = per_kind.select("page_id", F.greatest(F.lit(1), F.ceil(
        F.greatest("n_posts", "n_insights") / F.lit(CHUNK))).alias("n_chunks"))
    listed = entries.join(chunks_of, "page_id", "left").withColumn("n_chunks", F.coalesce("n_chunks", F.lit(1)))
    pages = listed.select("source", "page_id", "n_chunks")
    both_lists = F.col("page_id") % 10 == 0
    partial = (F.col("source") == "unmanaged") & both_lists
    partial_json = _json([F.col("id"), F.col("page_id"),
                          F.when(F.col("id") % 2 == 0, F.lit(None).cast("int")).otherwise(F.col("likes")).alias("likes"),
                          F.col("message")])
    post_rows = posts.join(pages, "page_id").select(
        "source", "page_id", (F.col("id") % F.col("n_chunks")).alias("chunk"),
        F.struct(F.col("id"), F.when(partial, partial_json).otherwise(_json([F.col(c) for c in posts.columns]))
                 .alias("j")).alias("post"),
        F.lit(None).cast("struct<id:bigint,j:string>").alias("insight"))
    insight_rows = insights.join(pages, "page_id").select(
        "source", "page_id", (F.col("id") % F.col("n_chunks")).alias("chunk"),
        F.lit(None).cast("struct<id:bigint,j:string>").alias("post"),
        F.struct(F.col("id"), _json([F.col(c) for c in insights.columns]).alias("j")).alias("insight"))
    page_rows = listed.select("source", "page_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_chunks") - 1)).alias("chunk"),
                              F.struct("source_rank", "list_pos", "page_json").alias("page"))
    chunks = (post_rows.unionByName(insight_rows).unionByName(page_rows, allowMissingColumns=True)
              .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "source", "page_id", "chunk")
              .groupBy("source", "page_id", "chunk")
              .agg(F.sort_array(F.collect_list("post")).alias("posts"),
                   F.sort_array(F.collect_list("insight")).alias("insights"), F.max("page").alias("page"))
              .where((F.col("chunk") == 0) | (F.size("posts") + F.size("insights") > 0)))
    resp = chunks.select("source", "page_id", "chunk", "posts", "insights", "page.*")
    p = F.col("page_id")
    managed = F.col("source") == "managed"
    status = F.when(managed & (p % 23 == 0), F.lit(404)).otherwise(F.lit(200))
    success = F.when(managed, F.when(p % 29 == 0, F.lit("false")).otherwise(F.lit("true"))).otherwise(F.lit("1"))
    items = lambda a: F.array_join(F.transform(F.col(a), lambda e: e["j"]), ",")
    insights_part = F.when(~managed & (p % 7 == 0), F.lit("")).otherwise(
        F.concat(F.lit('"insights":['), items("insights"), F.lit("],")))
    body = F.concat(F.lit('{"success":'), success, F.lit(',"data":{"page":'), F.col("page_json"), F.lit(","),
                    insights_part, F.lit('"posts":['), items("posts"), F.lit("]}}"))
    return resp.select("source", "source_rank", "list_pos", "page_id", F.col("chunk").cast("int").alias("chunk"),
                       status.alias("status"), F.when(status == 200, body).otherwise(F.lit("not found")).alias("body"))
