"""What ingestion moves and computes per record."""

from __future__ import annotations

import json
import os

from paths import SF001
from pagemart.operators import upsert_partial
from pagemart.session import ensure_checkpoint_dir
from pagemart.sources import landing
from pagemart.sources.responses import check_responses, ingest
from pagemart.streaming.deltas import DeltaStore
from pagemart.streaming.ingest import stage_batch

LANDED = "source string, source_rank int, list_pos bigint, page_id int, chunk int, status int, body string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_body_is_shuffled_or_joined(spark):
    p = plan(landing.landed_responses(spark, SF001))
    above = p[:p.index("collect_list")]             # what comes after the records of a response are together
    assert "Join" not in above and "Exchange" not in above


def test_records_are_taken_out_once_and_judged_as_ever(spark):
    cases = [('{"page": {"id": 1}, "insights": [], "posts": null}', "posts is not an array"),
             ('{"page": {"id": 1}, "insights": [], "posts": {"id": 1}}', "posts is not an array"),
             ('{"page": {"id": 1}, "insights": 7}', "no insights array"),
             ('{"page": null, "insights": []}', "no data.page"),
             ('{"page": [1], "insights": []}', "page: record is not a JSON object"),
             ('{"page": {"id": 1, "actif": "x"}, "insights": 7}', "no insights array"),
             ('{"page": {"id": 1}, "insights": [{"id": 2}, null]}', "insight: record is not a JSON object"),
             ('{"page": {"id": 1}, "insights": [], "posts": [{"id": 1, "zz": null, "aa": 1}]}', "post: unknown column: aa,zz"),
             ('{"page": {"id": 1}, "insights": [], "posts": [{"id": null, "likes": "x"}]}', "post: record without id"),
             ('{"page": {"id": 1}, "insights": [], "posts": [{"id": 1, "likes": "x", "shares": 3000000000}]}', "post: bad value for shares"),
             ('{"page": {"id": 1}, "insights": [], "posts": [{"id": 1.6, "likes": null, "message": {"b": [1, null]}}]}', None)]
    rows = [("managed", 0, i, i, 0, 200, '{"success": 1, "data": %s}' % data) for i, (data, _) in enumerate(cases)]
    checked = check_responses(spark.createDataFrame(rows, LANDED))
    assert checked.schema["posts"].dataType.simpleString() == "array<map<string,string>>"
    assert [r.reason for r in checked.orderBy("page_id").collect()] == [reason for _, reason in cases]
    post = ingest(spark.createDataFrame(rows, LANDED)).posts.first()
    assert (post.id, post.likes, json.loads(post.message)) == (2, None, {"b": [1, None]})


def test_orders_are_kept_once_per_record(spark):
    recs = spark.createDataFrame([(1, 1, "x", "y", ["v", "w"]), (1, 2, "z", None, ["v"]), (2, 3, "a", None, ["v", "w"]), (3, 4, None, None, [])],
                                 "id int, seq int, v string, w string, present array<string>")
    got = {r.id: r.o for r in upsert_partial(recs, ["id"], ["seq"], "present", ["v", "w"], None, "o").collect()}
    assert [len(got[i]) for i in (1, 2, 3)] == [2, 1, 0] and got[2][0]["columns"] == ["v", "w"]


def test_a_staged_batch_is_read_by_column_and_removed(spark, scratch):
    rows = [("managed", 0, 0, 1, 0, 200, '{"success": 1, "data": {"page": {"id": 1}, "insights": [], "posts": [{"id": 5}]}}')]
    staged = ingest(spark.createDataFrame(rows, LANDED)).materialize()
    scan = next(line for line in plan(staged.clients).splitlines() if "FileScan" in line)
    assert "page#" in scan and "posts#" not in scan
    staged.release()
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = {f for f in os.listdir(top) if f.startswith("staged-")}
    stage_batch(spark, spark.createDataFrame(rows, LANDED), scratch, 0)
    assert {f for f in os.listdir(top) if f.startswith("staged-")} == before
    assert DeltaStore(spark, scratch).read("stg_posts").first().id == 5
