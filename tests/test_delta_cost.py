"""What a batch and a merge of deltas move: only records and rows whose key occurs more than once."""

from __future__ import annotations

import json
import random

import pytest

from pagemart.operators import upsert
from pagemart.sources.responses import ORDER, ingest
from pagemart.streaming.deltas import DeltaStore
from pagemart.streaming.ingest import stage_batch

LANDED = "source string, source_rank int, list_pos bigint, page_id int, chunk int, status int, body string"


def landed(spark, rows):
    return spark.createDataFrame([(("managed", "unmanaged")[rank], rank, pos, pos, 0, 200,
                                   json.dumps({"success": ok, "data": {"page": {"id": pos % 5, "name": f"p{rank}-{pos}"}, "insights": [{"id": pos, "page_id": pos}], "posts": posts}}))
                                  for rank, pos, ok, posts in rows], LANDED)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def orders(df):
    """Rows with the order of every stored value."""
    return sorted((str([r[c] for c in sorted(df.columns) if c != ORDER]), sorted((tuple(o["seq"]), tuple(sorted(o["columns"]))) for o in r[ORDER])) for r in df.collect())


def mixed(seed=3, n=30):
    """Ids of one record, of a few and of many; records with different keys, without any but the id, and of rejected responses."""
    rng = random.Random(seed)
    rows = []
    for pos in range(n):
        for rank in (0, 1):
            ids = [1000 + 10 * pos + rank, rng.randrange(40), rng.randrange(40), 7]
            posts = [{"id": i, **{c: rng.choice([None, rng.randrange(9)]) for c in rng.sample(["likes", "shares", "views", "message"], rng.randrange(5))}} for i in ids]
            rows.append((rank, pos, pos % 7 != 3, posts))
    rows.append((1, n, False, [{"id": 1000, "likes": 5}]))         # rejected: id 1000 still has one record
    rows.append((1, n + 1, True, [{"id": "5000.4"}, {"id": 5000}]))  # one id in two spellings
    return rows


@pytest.mark.parametrize("broadcast", [upsert.BROADCAST_KEYS, 0])
def test_records_alone_and_together_give_the_upsert(spark, monkeypatch, broadcast):
    monkeypatch.setattr(upsert, "BROADCAST_KEYS", broadcast)
    df = landed(spark, mixed())
    lazy, staged = ingest(df, track_order=True), ingest(df, track_order=True).materialize()
    for name in ("posts", "insights", "clients", "unmanaged_clients"):
        assert orders(getattr(staged, name)) == orders(getattr(lazy, name)), name
    assert [(f.name, f.dataType) for f in staged.posts.schema if f.name != ORDER] == [(f.name, f.dataType) for f in lazy.posts.schema if f.name != ORDER]
    rows = {r.id: r for r in staged.posts.collect()}
    assert len(rows[1000][ORDER]) == 1 and 5000 in rows
    staged.release()


def test_the_only_record_of_an_id_is_not_shuffled(spark):
    staged = ingest(landed(spark, mixed()), track_order=True).materialize()
    p = plan(staged.posts)
    single = p[:p.index("LeftSemi")]
    assert "LeftAnti" in single and "Exchange hashpartitioning" not in single.split("SortAggregate")[0]
    staged.release()


def test_columns_no_record_holds_are_not_taken_out_of_the_records(spark):
    staged = ingest(landed(spark, [(0, 1, True, [{"id": 1, "likes": 2}, {"id": 2}])]), track_order=True).materialize()
    p = plan(staged.posts)
    assert "[likes]" in p and "[shares]" not in p and staged.posts.schema["shares"].dataType.simpleString() == "int"
    nothing = ingest(landed(spark, [(0, 1, True, [{"id": 1}, {"id": 1}]), (0, 2, False, [])]), track_order=True).materialize()
    assert [(r.id, r.likes, r[ORDER]) for r in nothing.posts.collect()] == [(1, None, [])] and nothing.unmanaged_clients.count() == 0
    for s in (staged, nothing):
        s.release()


def test_deltas_without_a_common_id_are_read_as_they_are(spark, scratch):
    for i in range(2):
        stage_batch(spark, landed(spark, [(0, 10 * i + k, True, [{"id": 100 * i + k, "likes": k}]) for k in range(4)]), scratch, i)
    store = DeltaStore(spark, scratch)
    df = store.read("stg_posts")
    assert sorted((r.id, r.likes) for r in df.collect()) == [(100 * i + k, k) for i in range(2) for k in range(4)]
    final = plan(df).split("== Initial Plan ==")[0]
    assert "Exchange hashpartitioning" not in final and "SortAggregate" not in final
    assert [r["columns"] for r in store.read("stg_posts", with_order=True).where("id = 101").first()[ORDER]] == [["likes"]]


def test_a_failed_output_fails_the_batch(spark, scratch, monkeypatch):
    write = DeltaStore.write_delta

    def fails(self, df, table):
        if table == "stg_insights":
            raise OSError("no space")
        write(self, df, table)
    monkeypatch.setattr(DeltaStore, "write_delta", fails)
    with pytest.raises(OSError):
        stage_batch(spark, landed(spark, mixed(n=2)), scratch, 0)
    assert DeltaStore(spark, scratch).versions() == []
