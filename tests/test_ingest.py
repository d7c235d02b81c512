"""Ingestion: page lists, acceptance rules, record-driven upsert, streaming batches."""

from __future__ import annotations

import json
import os

import pytest

from pyspark.sql import functions as F

from paths import SF001
from pagemart.plans.refresh import LayerStore
from pagemart.sources import landing, pagelists
from pagemart.sources.responses import ingest
from pagemart.streaming.deltas import DeltaStore
from pagemart.streaming.ingest import STAGING_TABLES, start_ingest_stream

LANDED = "source string, source_rank int, list_pos bigint, page_id int, chunk int, status int, body string"


def body(page, insights=None, posts=None, success="true", drop=()):
    data = {"page": page, "insights": insights or [], "posts": posts or []}
    for k in drop:
        data.pop(k)
    return '{"success": %s, "data": %s}' % (success, json.dumps(data))


def landed(spark, rows):
    return spark.createDataFrame(rows, LANDED)


def test_managed_list_file_order(spark, scratch):
    p = os.path.join(scratch, "managed.json")
    with open(p, "w") as f:
        json.dump({"success": True, "message": "", "data": [
            {"id": 468854, "name": "Société", "social_type": "facebook", "managed": 1},
            {"id": 5, "name": "Pneus-SCP", "social_type": "ytb", "managed": 1}]}, f, indent=2)
    got = [tuple(r) for r in pagelists.read_managed_list(spark, p).collect()]
    assert got == [(0, 468854, "Société", "facebook", 1), (1, 5, "Pneus-SCP", "ytb", 1)]


def test_unmanaged_list_page_or_id(spark, scratch):
    p = os.path.join(scratch, "unmanaged.json")
    with open(p, "w") as f:
        json.dump({"data": [{"page": {"id": 7}}, {"id": 8}, {}]}, f, indent=2)
    got = [tuple(r) for r in pagelists.read_unmanaged_list(spark, p).collect()]
    assert got == [(0, 7), (1, 8), (2, None)]
    managed = spark.createDataFrame([(0, 1, "a", "facebook", 1)], "list_pos int, id int, name string, social_type string, managed int")
    entries = pagelists.list_entries(managed, pagelists.read_unmanaged_list(spark, p))
    assert [(r.source, r.list_pos) for r in pagelists.invalid_entries(entries).collect()] == [("unmanaged", 2)]
    assert [r.source_rank for r in entries.orderBy("source_rank", "list_pos").collect()] == [0, 1, 1, 1]
    lines = os.path.join(scratch, "unmanaged.jsonl")
    with open(lines, "w") as f:
        f.write('{"page": {"id": 7}}\n{"id": 8}\n')
    assert [r.id for r in pagelists.read_unmanaged_list(spark, lines, multiline=False).orderBy("list_pos").collect()] == [7, 8]


def test_acceptance_rules(spark):
    page = {"id": 1, "name": "p"}
    rows = [("managed", 0, 0, 1, 0, 404, body(page)),
            ("managed", 0, 1, 2, 0, 200, body({"id": 2}, success="false")),
            ("managed", 0, 2, 3, 0, 200, '{"success": true, "data": {}}'),
            ("managed", 0, 3, 4, 0, 200, body({"id": 4}, drop=("insights",))),
            ("managed", 0, 4, 5, 0, 200, body({"id": 5}, drop=("posts",))),
            ("managed", 0, 5, 6, 0, 200, body({"id": 6}, success='"yes"')),
            ("managed", 0, 6, 7, 0, 200, "[1, 2]"),
            ("managed", 0, 7, 8, 0, 200, body({"id": 8}, posts=[{"id": 80, "bogus": 1}])),
            ("managed", 0, 8, 9, 0, 200, body({"id": 9}, posts=[{"likes": 1}])),
            ("managed", 0, 9, 10, 0, 200, body({"id": 10}, insights=[{"id": 5, "day": "not a day"}]))]
    st = ingest(landed(spark, rows))
    reasons = {r.page_id: r.reason for r in st.rejects.collect()}
    assert reasons == {1: "http status 404", 2: "success is false or missing", 3: "no data.page",
                       4: "no insights array", 7: "success is false or missing",
                       8: "post: unknown column: bogus", 9: "post: record without id",
                       10: "insight: bad value for day"}
    assert sorted(r.id for r in st.clients.collect()) == [5, 6]


def test_record_driven_upsert_and_order(spark):
    rows = [("managed", 0, 0, 1, 0, 200, body({"id": 1, "name": "a", "actif": 1},
                                               posts=[{"id": 9, "likes": 3, "message": "m", "type": "x"}])),
            ("unmanaged", 1, 0, 1, 0, 200, body({"id": 1, "name": None},
                                                 posts=[{"id": 9, "likes": None}, {"id": 9, "message": "last"}]))]
    st = ingest(landed(spark, rows))
    p = st.posts.first()
    assert (p.likes, p.message, p.type) == (None, "last", "x")
    assert [(r.id, r.name, r.actif) for r in st.unmanaged_clients.collect()] == [(1, None, None)]
    assert [(r.id, r.name, r.actif) for r in st.clients.collect()] == [(1, "a", 1)]


def test_values_coerced_like_bound_parameters(spark):
    post = {"id": "12", "page_id": 1, "likes": "7", "comments": 2.6, "creation_time": "2024-05-01T10:00:00+0000",
            "message": "a\u0000b", "data": {"data": {"total_video_views": 3}}}
    st = ingest(landed(spark, [("managed", 0, 0, 1, 0, 200, body({"id": 1}, posts=[post]))]))
    p = st.posts.first()
    assert (p.id, p.likes, p.comments, p.message) == (12, 7, 3, "ab")
    assert str(p.creation_time) == "2024-05-01 10:00:00"
    assert json.loads(p.data) == {"data": {"total_video_views": 3}}


def test_streaming_batches_upsert_into_previous_version(spark, scratch):
    land = os.path.join(scratch, "landing")
    root = os.path.join(scratch, "staging")
    first = landed(spark, [("managed", 0, 0, 1, 0, 200, body({"id": 1, "name": "a"},
                                                               posts=[{"id": 9, "likes": 3, "message": "m"}]))])
    first.write.parquet(os.path.join(land, "part=1"))
    q = start_ingest_stream(spark, land, root, os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    second = landed(spark, [("managed", 0, 0, 1, 0, 200, body({"id": 1}, posts=[{"id": 9, "likes": None}]))])
    second.write.parquet(os.path.join(land, "part=2"))
    q = start_ingest_stream(spark, land, root, os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    store = DeltaStore(spark, root)
    post = store.read("stg_posts").first()
    assert (post.id, post.likes, post.message) == (9, None, "m")
    assert store.read("stg_clients").first().name == "a"
    assert set(STAGING_TABLES) <= {"stg_clients", "stg_unmanaged_clients", "stg_insights", "stg_posts"}


def test_daily_paths_separate_loads():
    from pagemart.streaming.ingest import daily_paths
    a, b = daily_paths("/shared/x/", "2025-01-01"), daily_paths("/shared/x", "2025-01-02")
    assert a["root"] != b["root"] and a["checkpoint_dir"] != b["checkpoint_dir"]
    assert a["landing_dir"] == "/shared/x/landed/2025-01-01"


def test_landing_fixture_rejects_and_pages(spark):
    lr = landing.landed_responses(spark, SF001)
    st = ingest(lr)
    n_rejected_pages = st.rejects.select("source", "page_id").distinct().count()
    assert n_rejected_pages > 0
    # every accepted managed page is staged exactly once
    assert st.clients.count() == st.clients.select("id").distinct().count()
    assert st.posts.where(F.col("id").isNull()).count() == 0


def test_run_fails_above_reject_ratio(spark):
    import pytest
    from pagemart.sources.responses import RejectedTooMany
    rows = [("managed", 0, 0, 1, 0, 404, "x"), ("managed", 0, 1, 2, 0, 200, body({"id": 2})),
            ("managed", 0, 2, 3, 0, 500, "x")]
    st = ingest(landed(spark, rows))
    assert abs(st.reject_ratio() - 2 / 3) < 1e-9
    ingest(landed(spark, rows), max_reject_ratio=0.7)
    with pytest.raises(RejectedTooMany):
        ingest(landed(spark, rows), max_reject_ratio=0.5)


def test_stream_batch_over_reject_ratio_is_not_committed(spark, scratch):
    import pytest
    from pagemart.sources.responses import RejectedTooMany
    from pagemart.streaming.ingest import stage_batch
    root = os.path.join(scratch, "staging")
    rows = [("managed", 0, 0, 1, 0, 404, "x"), ("managed", 0, 1, 2, 0, 200, body({"id": 2}))]
    with pytest.raises(RejectedTooMany):
        stage_batch(spark, landed(spark, rows), root, 0, max_reject_ratio=0.25)
    assert LayerStore(spark, root).latest_run() is None
    stage_batch(spark, landed(spark, rows), root, 1, max_reject_ratio=0.75)
    assert LayerStore(spark, root).latest_run() == "b000000000001"


def test_materialized_staging_equals_lazy(spark):
    lr = landing.landed_responses(spark, SF001)
    lazy, mat = ingest(lr), ingest(lr).materialize()
    for name in ("clients", "unmanaged_clients", "insights", "posts", "rejects"):
        a, b = getattr(lazy, name), getattr(mat, name)
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str), name


def test_latest_run_before(spark, scratch):
    store = LayerStore(spark, scratch, run_id="b000000000001")
    store.commit()
    LayerStore(spark, scratch, run_id="b000000000003").commit()
    s = LayerStore(spark, scratch)
    assert s.latest_run() == "b000000000003"
    assert s.latest_run(before="b000000000003") == "b000000000001"
    assert s.latest_run(before="b000000000001") is None


def test_refresh_job_needs_committed_staging(spark, scratch):
    import pytest
    from pagemart import jobs
    with pytest.raises(FileNotFoundError):
        jobs.run_refresh(spark, scratch, "2025-03-01")


def test_staging_independent_of_landed_row_order(spark):
    lr = landing.landed_responses(spark, SF001)
    a = ingest(lr.repartition(7, "page_id")).posts
    b = ingest(lr.repartition(3).sortWithinPartitions(F.rand(seed=5))).posts
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_lists_stop_on_broken_documents(spark, scratch):
    from py4j.protocol import Py4JError
    from pyspark.errors import PySparkException
    cut, bare = os.path.join(scratch, "cut.json"), os.path.join(scratch, "bare.json")
    with open(cut, "w") as f:
        f.write('{"data": [{"id": 1}, {"id"')
    with open(bare, "w") as f:
        f.write('{"success": true}')
    for p in (cut, bare):
        with pytest.raises((PySparkException, Py4JError)):
            pagelists.read_unmanaged_list(spark, p).collect()


def test_list_order_is_file_order(spark, scratch):
    d = os.path.join(scratch, "lists")
    os.makedirs(d)
    for name, ids in (("a.jsonl", range(3)), ("b.jsonl", range(100, 2100))):
        with open(os.path.join(d, name), "w") as f:
            f.write("".join('{"id": "%d"}\n' % i for i in ids))
    got = [r.id for r in pagelists.read_unmanaged_list(spark, d, multiline=False).orderBy("list_pos").collect()]
    assert got == [*range(3), *range(100, 2100)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")              # a split for every dozen entries
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        split = pagelists.read_unmanaged_list(spark, d, multiline=False)
        assert [r.id for r in split.orderBy("list_pos").collect()] == got and split.agg({"list_pos": "max"}).first()[0] == len(got) - 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    entries = spark.createDataFrame([("unmanaged", 1, 0, 5), ("unmanaged", 1, 1, 6)], "source string, source_rank int, list_pos bigint, page_id int")
    landed = spark.createDataFrame([("unmanaged", 1, 0, 6, 0, 200, "{}")], LANDED)
    assert [r.page_id for r in pagelists.without_response(entries, landed).collect()] == [5]


def test_records_landed_one_by_one(spark):
    """The same responses whole and record by record give the same tables and rejects."""
    from pagemart.sources.responses import ingest_records
    page = {"id": 1, "name": "p"}
    answers = [("managed", 0, 0, 1, 0, 200, page, [{"id": 10, "page_id": 1}], [{"id": 20, "likes": 3}, {"id": 21, "message": "m", "likes": None}]),
               ("managed", 0, 1, 2, 0, 200, {"id": 2}, [{"id": 11, "bogus": 1}], [{"id": 22}]),
               ("managed", 0, 2, 3, 0, 404, {"id": 3}, [], [{"id": 23}]),
               ("unmanaged", 1, 0, 4, 0, 200, {"id": 4}, [], [{"id": 20, "likes": None}, {"id": 24, "likes": "x"}])]
    whole = spark.createDataFrame([(*a[:6], body(a[6], a[7], a[8])) for a in answers], LANDED)
    rows = []
    for a in answers:
        rows.append((*a[:6], body(a[6]), "envelope", None))
        rows += [(*a[:6], json.dumps(r), part, i) for part, rs in (("insight", a[7]), ("post", a[8])) for i, r in enumerate(rs)]
    by_record = ingest_records(spark.createDataFrame(rows, LANDED + ", part string, array_pos int"))
    staged = ingest(whole)
    for t in ("clients", "unmanaged_clients", "insights", "posts"):
        assert sorted(map(str, getattr(by_record, t).collect())) == sorted(map(str, getattr(staged, t).collect())), t
    reasons = lambda s: sorted((r.page_id, r.reason) for r in s.rejects.collect())
    assert reasons(by_record) == reasons(staged) and len(reasons(staged)) == 3


def test_a_very_long_value_is_staged_by_record(spark):
    from pyspark.sql import functions as F
    from pagemart.sources.responses import ingest_records
    env = spark.createDataFrame([("managed", 0, 0, 1, 0, 200, body({"id": 1}), "envelope", None)], LANDED + ", part string, array_pos int")
    long = spark.range(1).select(F.concat(F.lit('{"id": 5, "message": "'), F.expr("repeat('x', CAST(id AS INT) + 25000000)"), F.lit('"}')).alias("b"))
    rec = env.drop("body", "part", "array_pos").crossJoin(long).select("*", F.lit("post").alias("part"), F.lit(0).alias("array_pos")).withColumnRenamed("b", "body")
    out = ingest_records(env.unionByName(rec))
    assert out.posts.select(F.length("message").alias("n")).first().n == 25_000_000 and out.rejects.count() == 0
    whole = env.drop("part", "array_pos", "body").crossJoin(long.select(F.concat(
        F.lit('{"success": true, "data": {"page": {"id": 1}, "insights": [], "posts": ['), "b", F.lit("]}}")).alias("body")))
    assert "too large" in ingest(whole).rejects.first().reason
