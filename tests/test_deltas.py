"""Staging as base and deltas, and refreshes that go on where one stopped."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest

from pagemart.plans import dw
from pagemart.plans.refresh import LayerStore, refresh
from pagemart.sources import testdata
from pagemart.sources.responses import ingest
from pagemart.streaming.deltas import DeltaStore
from pagemart.streaming.ingest import stage_batch, version_id
from paths import SF001

LANDED = "source string, source_rank int, list_pos bigint, page_id int, chunk int, status int, body string"


def response(rank, pos, posts, status=200):
    body = json.dumps({"success": True, "data": {"page": {"id": pos, "name": f"p{rank}"}, "insights": [{"id": pos, "page_id": pos}], "posts": posts}})
    return (("managed", "unmanaged")[rank], rank, pos, pos, 0, status, body)


def responses(n=24):
    rng = random.Random(7)
    out = []
    for pos in range(n):
        for rank in (0, 1):
            posts = [{"id": rng.randrange(40), **{c: rng.choice([None, rng.randrange(9)]) for c in rng.sample(["likes", "shares", "views"], rng.randrange(4))}}
                     for _ in range(6)]
            out.append(response(rank, pos, posts))
    return out


def table(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def files_of(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("cuts, compactions", [([5, 30, 48], {1: range(0, 8, 2), 2: None}), ([1, 2, 20, 48], {0: None, 2: [1, 3, 5]})])
def test_any_split_and_compaction_gives_one_table(spark, scratch, cuts, compactions):
    rows = responses()
    random.Random(len(cuts)).shuffle(rows)                  # records come in any order
    whole = ingest(spark.createDataFrame(rows, LANDED))
    first = 0
    for i, stop in enumerate(cuts):
        before = files_of(scratch)
        stage_batch(spark, spark.createDataFrame(rows[first:stop], LANDED), scratch, i)
        assert before <= files_of(scratch)                  # nothing stored before is rewritten
        delta = spark.read.parquet(f"{scratch}/stg_posts/delta/version={version_id(i)}")
        own = {p["id"] for r in rows[first:stop] for p in json.loads(r[-1])["data"]["posts"]}
        assert sorted(r.id for r in delta.collect()) == sorted(own)      # a batch writes its own keys
        if i in compactions:
            DeltaStore(spark, scratch, buckets=8).compact(["stg_posts", "stg_clients"], compactions[i])
        first = stop
    store = DeltaStore(spark, scratch, buckets=8)
    for name, want in (("stg_posts", whole.posts), ("stg_clients", whole.clients), ("stg_insights", whole.insights), ("stg_unmanaged_clients", whole.unmanaged_clients)):
        assert table(store.read(name)) == table(want), name


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(DeltaStore, "__init__", _with_buckets(DeltaStore.__init__, 8))


def _with_buckets(init, n):
    def start(self, *args, **kwargs):
        kwargs.setdefault("buckets", n)
        init(self, *args, **kwargs)
    return start


def test_retried_and_uncommitted_batches(spark, scratch):
    rows = responses(6)
    stage_batch(spark, spark.createDataFrame(rows[:4], LANDED), scratch, 0)
    want = table(DeltaStore(spark, scratch).read("stg_posts"))
    store = DeltaStore(spark, scratch, run_id=version_id(1))
    store.write_delta(ingest(spark.createDataFrame(rows[4:], LANDED), track_order=True).posts, "stg_posts")     # stopped before its marker
    assert table(DeltaStore(spark, scratch).read("stg_posts")) == want
    stage_batch(spark, spark.createDataFrame(rows[4:], LANDED), scratch, 1)                                     # the retry
    whole = table(ingest(spark.createDataFrame(rows, LANDED)).posts)
    assert table(DeltaStore(spark, scratch).read("stg_posts")) == whole
    assert table(DeltaStore(spark, scratch).read("stg_posts", version_id(0))) == want
    name = DeltaStore(spark, scratch).compact(["stg_posts"])
    assert DeltaStore(spark, scratch)._states()[0] == name == "000000000001"
    stage_batch(spark, spark.createDataFrame(rows[4:], LANDED), scratch, 1)                                     # retried once more, already in the base
    assert table(DeltaStore(spark, scratch).read("stg_posts")) == whole
    with pytest.raises(ValueError):
        DeltaStore(spark, scratch).read("stg_posts", version_id(0))
    with pytest.raises(ValueError):
        DeltaStore(spark, scratch, run_id="b00").write_delta(whole and ingest(spark.createDataFrame(rows, LANDED), track_order=True).posts, "stg_posts")


def test_empty_batches_and_automatic_compaction(spark, scratch):
    assert DeltaStore(spark, scratch).compact(["stg_posts"]) is None
    with pytest.raises(FileNotFoundError):
        DeltaStore(spark, scratch).read("stg_posts")
    stage_batch(spark, spark.createDataFrame([], LANDED), scratch, 0)
    assert DeltaStore(spark, scratch).compact(["stg_posts"]) is not None
    assert DeltaStore(spark, scratch).read("stg_posts").count() == 0
    rows = responses(2)
    for i, r in enumerate(rows, 1):
        stage_batch(spark, spark.createDataFrame([r], LANDED), scratch, i, compact_every=3)
    assert table(DeltaStore(spark, scratch).read("stg_posts")) == table(ingest(spark.createDataFrame(rows, LANDED)).posts)
    assert DeltaStore(spark, scratch).open_deltas() < 3


# ---- refresh -------------------------------------------------------------------------------------

def test_a_stopped_refresh_goes_on(spark, scratch, monkeypatch):
    stg = testdata.Staging(spark, SF001)
    staging = {"stg_clients": stg.clients, "stg_unmanaged_clients": stg.unmanaged_clients, "stg_posts": stg.posts, "stg_insights": stg.insights}

    def run(end=dt.date(2025, 1, 1)):
        store = LayerStore(spark, scratch, source="day 1")
        return refresh(spark, staging, store, start=dt.date(1990, 1, 1), end=end), store
    with monkeypatch.context() as m:
        m.setattr(dw, "fact_insights", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert LayerStore(spark, scratch).latest_run() is None
    left = files_of(scratch)
    out, store = run()
    written = set(store.paths) - set(store.reused)
    assert written == {"fact_insights", "fact_fan_demographics", "broken_keys"} and left < files_of(scratch)
    plain = LayerStore(spark, scratch + "-plain")
    want = refresh(spark, staging, plain, start=dt.date(1990, 1, 1), end=dt.date(2025, 1, 1))
    for t in ("ods_posts", "dim_location", "fact_posts", "fact_insights", "fact_fan_demographics", "broken_keys"):
        assert table(out[t]) == table(want[t]) == table(LayerStore(spark, scratch).read(t)), t
    again, second = run()                                   # nothing changed: nothing is written, the run is committed
    assert not set(second.paths) - set(second.reused) and LayerStore(spark, scratch).latest_run() == second.run_id
    _, later = run(end=dt.date(2025, 1, 2))                 # one setting: only what depends on it
    assert set(later.paths) - set(later.reused) == {"dim_date", "fact_posts", "fact_insights", "fact_fan_demographics", "broken_keys"}
    other = LayerStore(spark, scratch, source="day 2")      # another source: nothing fits
    other.layer("dim_date", lambda: spark.range(1))
    assert not other.reused
