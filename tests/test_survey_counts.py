"""Counts probed independently on both engines when the design was written,
reproduced by the Spark jobs at sf0.01."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as E
from paths import SF01
from pagemart.functions import has_json
from pagemart.operators.explode import explode_json_object
from pagemart.plans import ods
from pagemart.sources import testdata


def test_ods_counts(spark):
    q = E.queries()
    assert q["ods_clients"](spark, SF01).count() == 907
    assert q["ods_posts"](spark, SF01).count() == 8205
    assert q["ods_posts_strict"](spark, SF01).count() == 5880
    assert q["ods_insights"](spark, SF01).count() == 2382


def test_post_type_distribution(spark):
    got = {r[0]: r[1] for r in E.queries()["clean_post_type"](spark, SF01).groupBy("post_type").count().collect()}
    assert got == {"Photo": 3003, "Reels": 3353, "Story": 5242, "Texte": 1140, "Video": 1113, None: 1149}


def test_fan_entries_over_all_insights(spark):
    ins = testdata.stg_insights(spark, SF01)
    want = {"country": (6976, 5581, 259120), "city": (8406, 8406, 79235), "locale": (8176, 8176, 405361)}
    for kind, (col, _, repair) in ods.FAN_KINDS.items():
        src = ins.where(has_json(F.col(col)))
        every = explode_json_object(src, repair(F.col(col)), ["id"], "k", first_wins=False)
        first = explode_json_object(src, repair(F.col(col)), ["id"], "k")
        total = every.agg(F.sum(F.col("value").try_cast("int"))).first()[0]
        assert (every.count(), first.count(), total) == want[kind], kind
