"""Surrogate keys at the edges: labels that begin alike, ids over several runs, dense ids of large tables."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pagemart.operators import continued_ids, dense_ids, sequential_ids
from pagemart.operators.keys import RANGES, _drawn_ranges
from pagemart.plans.refresh import LayerStore, refresh
from pagemart.plans import constraints
from pagemart.sources import testdata
from paths import SF001


def test_labels_with_one_prefix_are_spread(spark):
    n = 100_000
    labels = spark.range(n).select(F.concat(F.lit("The one prefix of all "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("label"))
    sizes = [r["count"] for r in _drawn_ranges(labels.repartition(5), ["label"]).groupBy("__b").count().collect()]
    assert len(sizes) == RANGES and max(sizes) < 12 * n / RANGES
    wrong = sequential_ids(labels, ["label"], "id").where("id <> CAST(right(label, 6) AS INT) + 1")
    assert wrong.count() == 0


def test_ranges_with_few_and_null_keys(spark):
    for keys in ([], [None], [None, "", "a"], ["b"] ):
        df = spark.createDataFrame([(k,) for k in keys], "label string")
        got = sorted((r.id, r.label) for r in sequential_ids(df, ["label"], "id").collect())
        assert [g[1] for g in got] == keys and [g[0] for g in got] == list(range(1, len(keys) + 1))


def test_ids_outlive_runs(spark):
    frame = lambda *xs: spark.createDataFrame([("t", x) for x in xs], "kind string, label string")
    key = ["kind", "label"]
    ids = lambda df: {r.label: r.id for r in df.collect()}
    first = continued_ids(frame("b", "d", None), key, "id")
    assert ids(first) == {None: 1, "b": 2, "d": 3}
    second = continued_ids(frame("a", "d", "c"), key, "id", first)          # null and b are gone, but stay registered
    assert ids(second) == {None: 1, "b": 2, "d": 3, "a": 4, "c": 5}
    assert ids(continued_ids(frame(None, "b"), key, "id", second)) == ids(second)
    assert ids(continued_ids(frame(), key, "id", second)) == ids(second)
    assert ids(continued_ids(frame("x"), key, "id", first.limit(0))) == {"x": 1}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_dense_ids(spark, adaptive):
    rng = random.Random(4)
    rows = [(rng.randrange(40), rng.choice(["x", "y", None]), i) for i in range(5000)] + [(7, "hot", i % 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, c long").repartition(9)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = dense_ids(df, ["a", "b"], "n").orderBy("n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    order = lambda r: (r[0], r[1] is not None, r[1] or "", r[2])
    assert [r.n for r in got] == list(range(1, len(rows) + 1))
    assert [tuple(r)[:3] for r in got] == sorted(rows, key=order)
    assert dense_ids(df.limit(0), ["a"], "n").count() == 0


def test_refreshes_keep_label_ids(spark, scratch):
    stg = testdata.Staging(spark, SF001)
    end = dt.date(2025, 1, 1)

    def run(posts, insights):
        store = LayerStore(spark, scratch)
        staging = {"stg_clients": stg.clients, "stg_unmanaged_clients": stg.unmanaged_clients, "stg_posts": posts, "stg_insights": insights}
        return refresh(spark, staging, store, start=dt.date(1990, 1, 1), end=end, keep_keys=True), store
    few = stg.insights.withColumn("page_fans_city", F.lit(None).cast("string")).withColumn("page_fans_country", F.lit('{"ZZ":1}'))
    a, _ = run(stg.posts.where("type IS NULL"), few)
    b, _ = run(stg.posts, stg.insights)
    ids = lambda df, key, i: {tuple(r[k] for k in key): r[i] for r in df.collect()}
    for table, key, i in (("dim_location", ["location_type", "location_label"], "location_id"), ("dim_post_type", ["label"], "post_type_id")):
        old, new = ids(a[table], key, i), ids(b[table], key, i)
        assert all(new[k] == v for k, v in old.items() if k in new) and set(new) - set(old)
        assert min(v for k, v in new.items() if k not in old) > max(old.values())
        assert len(set(new.values())) == len(new)
    assert ("country", "ZZ") in ids(a["dim_location"], ["location_type", "location_label"], "location_id")
    assert ("country", "ZZ") not in ids(b["dim_location"], ["location_type", "location_label"], "location_id")
    c, _ = run(stg.posts, few)                                                    # ZZ comes back under its first id
    zz = lambda t: t["dim_location"].where("location_label = 'ZZ'").first().location_id
    assert zz(c) == zz(a)
    assert b["broken_keys"].where("broken LIKE 'unique%' OR broken LIKE '%dim_location%'").count() == 0
    assert b["fact_fan_demographics"].join(b["dim_location"], "location_id", "left_anti").count() == 0


def test_violations_of_every_kind(spark):
    ids = lambda rows, schema: spark.createDataFrame(rows, schema)
    tables = {
        "stg_posts": ids([(1,), (1,), (None,), (2,)], "id long"),
        "ods_clients": ids([(1,), (2,)], "client_id int"),
        "ods_insights": ids([(10, 1), (11, 9), (12, None), (13, 9)], "insight_id long, client_id int"),
        "ods_fans_city": ids([(10, "a|b", 1), (10, "a|b", 1), (10, None, 2), (99, "c", 2), (11, "c", 2)], "insight_id long, city string, client_id int"),
        "dim_location": ids([(1, "city", "a"), (2, "city", "a"), (3, "city", None), (4, "city", None)], "location_id int, location_type string, location_label string"),
        "fact_fan_demographics": ids([(1, 1, 1, 3), (2, 1, None, 7), (2, 5, 1, 7)], "fact_id long, client_id int, date_id int, location_id int"),
        "unrelated": ids([(1,), (1,)], "id int"),
    }
    got = sorted(map(tuple, constraints.violations(tables).collect()))
    assert got == sorted([
        ("primary key stg_posts(id)", "1", 2), ("primary key stg_posts(id)", "NULL", 1),
        ("primary key ods_fans_city(insight_id, city)", "10|a|b", 2), ("primary key ods_fans_city(insight_id, city)", "10|NULL", 1),
        ("unique dim_location(location_type, location_label)", "city|a", 2),
        ("primary key fact_fan_demographics(fact_id)", "2", 2),
        ("foreign key to ods_clients of ods_insights(client_id)", "9", 2),
        ("foreign key to ods_insights of ods_fans_city(insight_id)", "99", 1),
        ("foreign key to dim_location of fact_fan_demographics(location_id)", "7", 2)])
    assert constraints.violations({"unrelated": tables["unrelated"]}) is None
    assert {r.broken.split(" ")[0] for r in constraints.violations(tables, [constraints.UNIQUE]).collect()} == {"unique"}
