"""Operators on literal rows: upserts, first-wins, JSON explode, keys, quality checks."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from pagemart.operators import (bad_json, date_key, duplicate_keys, explode_json_object, first_wins, insert_ignore,
                                insert_or_replace, orphans, sequential_ids, unique_violations, upsert_partial)
from pagemart.plans import dw


def _key(t):
    return tuple((v is not None, v) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_first_wins_is_order_total_and_input_order_free(spark):
    data = [(k, i, f"v{k}-{i}") for k in range(20) for i in range(5)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, pos int, v string").repartition(7)
        out = first_wins(df, ["k"], ["pos"])
        assert rows(out, "k", "v") == [(k, f"v{k}-0") for k in range(20)]


def test_insert_ignore_keeps_target_rows(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new", 0), (2, "b2", 1), (2, "b1", 0)], "k int, v string, pos int")
    out = insert_ignore(new.select("k", "v", "pos"), ["k"], ["pos"], target.withColumn("pos", F.lit(None).cast("int")))
    assert rows(out, "k", "v") == [(1, "old"), (2, "b1")]


def test_insert_or_replace(spark):
    target = spark.createDataFrame([(1, "old"), (3, "keep")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "add")], "k int, v string")
    assert rows(insert_or_replace(new, ["k"], target), "k", "v") == [(1, "new"), (2, "add"), (3, "keep")]


def test_upsert_partial_absent_keeps_null_overwrites(spark):
    recs = spark.createDataFrame(
        [(1, 1, "x", "y", ["v", "w"]), (1, 2, None, None, ["v"])],
        "id int, seq int, v string, w string, present array<string>")
    out = upsert_partial(recs, ["id"], ["seq"], "present", ["v", "w"]).first()
    assert (out["v"], out["w"]) == (None, "y")


def test_upsert_partial_against_target(spark):
    target = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "id int, v string, w string")
    recs = spark.createDataFrame([(1, 5, "z", None, ["v"]), (3, 1, "n", "m", ["v", "w"])],
                                 "id int, seq int, v string, w string, present array<string>")
    out = upsert_partial(recs, ["id"], ["seq"], "present", ["v", "w"], target)
    assert rows(out, "id", "v", "w") == [(1, "z", "b"), (2, "c", "d"), (3, "n", "m")]


def test_upsert_partial_input_order_free(spark):
    data = [(k, s, f"{k}:{s}", ["v"] if s % 2 else ["v", "w"]) for k in range(10) for s in range(6)]
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "id int, seq int, v string, present array<string>") \
            .withColumn("w", F.col("v")).repartition(5)
        got = rows(upsert_partial(df, ["id"], ["seq"], "present", ["v", "w"]), "id", "v", "w")
        want = want or got
        assert got == want
    assert want[0] == (0, "0:5", "0:4")


def test_explode_first_wins_and_nulls(spark):
    df = spark.createDataFrame([(1, '{"a":1,"a":2,"b":3}'), (2, '{"a":null}'), (3, None), (4, "{bad"), (5, "{}")],
                               "id int, t string")
    out = explode_json_object(df, F.col("t"), ["id"], "key", pos_name="pos")
    assert rows(out, "id", "key", "value", "pos") == [(1, "a", "1", 0), (1, "b", "3", 2), (2, "a", None, 0)]


def test_explode_clean_labels_collide_first_wins(spark):
    from pagemart.functions import blank_to_null
    df = spark.createDataFrame([(1, '{" Tunis ":1,"Tunis":2,"  ":5,"Sfax":3}')], "id int, t string")
    out = explode_json_object(df, F.col("t"), ["id"], "key", key_fn=blank_to_null, drop_null_keys=True)
    assert rows(out, "key", "value") == [("Sfax", "3"), ("Tunis", "1")]


def test_date_key_matches_date_dimension(spark):
    start, end = dt.date(2010, 1, 1), dt.date(2010, 3, 1)
    dim = dw.dim_date(spark, start, end)
    assert dim.count() == 60
    first = dim.where(F.col("full_date") == F.lit(start)).first()
    assert (first["date_id"], first["week"], first["year"], first["quarter"]) == (1, 53, 2010, 1)
    probe = spark.createDataFrame([(dt.date(2009, 12, 31),), (dt.date(2010, 1, 1),), (dt.date(2010, 2, 15),),
                                   (dt.date(2010, 3, 2),)], "d date")
    joined = probe.join(dim, probe.d == dim.full_date, "left").select("d", "date_id")
    computed = probe.select("d", date_key(F.col("d"), start, end).alias("date_id"))
    assert rows(joined, "d", "date_id") == rows(computed, "d", "date_id")


def test_sequential_ids_dense_in_order(spark):
    labels = [f"l{i:04d}" for i in range(300)] + ["", "l", "é", "zz"]
    random.Random(1).shuffle(labels)
    df = spark.createDataFrame([(x,) for x in [*labels, None]], "label string").repartition(6)
    got = rows(sequential_ids(df, ["label"], "id"), "id", "label")
    assert got == [(1, None)] + [(i + 2, x) for i, x in enumerate(sorted(labels, key=str.encode))]
    pairs = spark.createDataFrame([(t, x) for t in ("country", "counter", "city") for x in labels[:50]], "t string, label string")
    got = rows(sequential_ids(pairs, ["t", "label"], "id", start=5), "id", "t", "label")
    assert got == [(i + 5, *p) for i, p in enumerate(sorted((t, x) for t in ("country", "counter", "city") for x in labels[:50]))]


def test_dim_location_union_null_once(spark):
    fans = spark.createDataFrame(
        [("country", 1, 1, dt.date(2024, 1, 1), None, 1), ("country", 2, 1, dt.date(2024, 1, 1), None, 2),
         ("city", 1, 1, dt.date(2024, 1, 1), "Sfax", 3)],
        "location_type string, insight_id long, client_id int, insight_date date, location_label string, nb_fans int")
    out = dw.dim_location(fans)
    assert rows(out, "location_id", "location_type", "location_label") == [(1, "city", "Sfax"), (2, "country", None)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None), (3, None)], "k int, u string")
    assert rows(duplicate_keys(df, ["k"]), "k", "n_rows") == [(None, 1), (1, 2)]
    assert unique_violations(df, ["u"]).count() == 0
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows(orphans(df, ["k"], parent), "k") == [(2,), (3,)]
    bad = ['{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1} x', '{"a":1}}', '{"a":1', "[1]", "{bad"]
    good = ['{"a}":1}', "{}", '{"a":1,"a":2}', ' {"a":{"b":null}} ', None]
    js = spark.createDataFrame([(i, t) for i, t in enumerate(bad + good)], "id int, t string")
    assert [r[0] for r in rows(bad_json(js, F.col("t"), ["id"]), "id")] == list(range(len(bad)))


def test_long_strings_in_json_texts(spark):
    from pagemart.functions import json_fields
    from pagemart.functions.jsontext import json_entries
    long = spark.range(1).select(F.concat(F.lit('{"k":"'), F.repeat(F.lit("x"), 25_000_000), F.lit('"}')).alias("t"))
    row = long.select(F.length(json_entries(F.col("t"))[0]["value"]).alias("a"), F.length(json_fields(F.col("t"), ["k"])["k"]).alias("b")).first()
    assert (row.a, row.b) == (25_000_000, 25_000_000)


def test_upsert_into_target(spark):
    target = spark.range(200).select(F.col("id").cast("int").alias("id"), F.col("id").cast("string").alias("v"),
                                     F.lit("w").alias("w"))
    recs = spark.createDataFrame([(3, 1, "a", None, ["v", "w"]), (3, 2, None, None, ["v"]), (500, 1, "n", "m", ["v", "w"])],
                                 "id int, seq int, v string, w string, present array<string>")
    got = {r.id: (r.v, r.w) for r in upsert_partial(recs, ["id"], ["seq"], "present", ["v", "w"], target).collect()}
    assert got[3] == (None, None) and got[500] == ("n", "m") and got[7] == ("7", "w") and len(got) == 201


def test_upsert_does_not_depend_on_batches(spark):
    rng = random.Random(3)
    data = [(rng.randrange(5), i, f"v{i}", f"w{i}", rng.sample(["v", "w"], rng.randrange(3))) for i in range(40)]
    schema = "id int, seq int, v string, w string, present array<string>"

    def staged(batches):
        target = None
        for b in batches:
            target = upsert_partial(spark.createDataFrame(b, schema), ["id"], ["seq"], "present", ["v", "w"], target, "o")
            target = spark.createDataFrame(target.collect(), target.schema)
        return rows(target, "id", "v", "w")
    whole = staged([data])
    shuffled = data[:]
    rng.shuffle(shuffled)
    assert staged([shuffled[:11], shuffled[11:20], shuffled[20:]]) == whole
    assert staged([data[30:], data[:30]]) == whole


def test_insert_or_replace_strict_rejects_repeated_keys(spark):
    import pytest
    from pyspark.errors import PySparkException
    target = spark.createDataFrame([(1, "old"), (9, "kept")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    for t in (target, None):
        merged = insert_or_replace(new, ["k"], t, strict=True, table="stg_pages")      # building it runs nothing
        for use in (merged, merged.select("k"), merged.groupBy().count()):
            with pytest.raises(PySparkException, match="DUPLICATE_KEY_IN_BATCH: stg_pages sets k=1 2 times"):
                use.collect()
    ok = spark.createDataFrame([(1, "a"), (2, "c"), (None, "n")], "k int, v string")
    assert rows(insert_or_replace(ok, ["k"], target, strict=True), "k", "v") == [(None, "n"), (1, "a"), (2, "c"), (9, "kept")]
    assert rows(insert_or_replace(ok, ["k"], strict=True), "k", "v") == [(None, "n"), (1, "a"), (2, "c")]


def test_orphans_by_bitmap(spark):
    from pagemart.operators import orphans_dense
    rng = random.Random(3)
    held = [rng.randrange(-70_000, 200_000) for _ in range(60_000)] + [0, 32_768, -32_768, 2 ** 40]
    used = [rng.choice(held) for _ in range(5000)] + [rng.randrange(-100_000, 300_000) for _ in range(300)] + [None, 0, 1, -1, 2 ** 40, 2 ** 40 + 1, 2 ** 41]
    parent = spark.createDataFrame([(k,) for k in held], "id bigint").repartition(5)
    child = spark.createDataFrame([(k, i) for i, k in enumerate(used)], "fk bigint, n int").repartition(4)
    want = rows(orphans(child, ["fk"], parent, ["id"]), "fk", "n")
    found = orphans_dense(child, "fk", parent, "id")
    assert rows(found, "fk", "n") == want and 2 ** 40 + 1 in {k for k, _ in want}
    assert rows(orphans_dense(child, "fk", parent.limit(0), "id"), "n") == [(i,) for i, k in enumerate(used) if k is not None]
    assert orphans_dense(child.limit(0), "fk", parent, "id").count() == 0
    # bitmaps are what is shuffled; the rows of the child meet the open buckets
    p = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in p and "LeftAnti" not in p
