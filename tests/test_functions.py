"""Literal edge rows for the scalar functions, predicates and JSON helpers (FIXTURES.md section 6)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagemart.functions import (blank_to_null, has_json, initcap_words, int_to_bool, json_entries, locale_braces,
                                platform_ok, post_type, reactions_total, simple_braces, strip_nul, to_int,
                                zero_to_null)
from pagemart.functions.posts import clean_post_type
from pagemart.plans.ods import video_columns


def col_values(spark, values, expr, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_initcap_words(spark):
    src = ["#EnergyFruits", "Societe Centrale Pneus-SCP", "oikos_by_dd", "Barista's Cafe", "20X pump", None, "",
           "élan VITAL ârabe"]
    want = ["#Energyfruits", "Societe Centrale Pneus-Scp", "Oikos_By_Dd", "Barista'S Cafe", "20x Pump", None, "",
            "Élan Vital Ârabe"]
    assert col_values(spark, src, initcap_words) == want


def test_platform_filter_three_valued(spark):
    df = spark.createDataFrame([("YTB",), ("TikTok",), (None,), ("facebook",), ("LinkedIn",), ("youtube",)], "x string")
    kept = [r[0] for r in df.where(platform_ok(F.col("x"))).collect()]
    assert kept == ["facebook"]


def test_int_to_bool(spark):
    assert col_values(spark, [0, 1, 2, None], int_to_bool, "x int") == [False, True, True, None]


def test_blank_and_zero_to_null(spark):
    assert col_values(spark, ["  a ", "   ", "", None, "\ta\t"], blank_to_null) == ["a", None, None, None, "\ta\t"]
    assert col_values(spark, [0, 3, None], zero_to_null, "x int") == [None, 3, None]


@pytest.mark.parametrize("type_, url, status, want", [
    ("", "/reel/9", None, "Reels"),
    (None, None, "", "Texte"),
    (None, None, None, "Texte"),
    (None, None, "x", None),
    (None, "/p/1", "added_photos", "Photo"),
    (None, None, "added_video", "Video"),
    (None, None, "mobile_status_update", "Reels"),
    (None, None, "shared_story", "Story"),
    (None, None, "storie_photo", "Story"),
    (" storie ", None, None, " storie "),
    ("storie", None, None, "storie"),
    ("Photo", "/reel/1", "added_video", "Photo"),
])
def test_post_type_as_loaded(spark, type_, url, status, want):
    df = spark.createDataFrame([(type_, url, status)], "t string, u string, s string")
    assert df.select(post_type(F.col("t"), F.col("u"), F.col("s"))).first()[0] == want


@pytest.mark.parametrize("loaded, want", [
    ("storie", "Story"), (" storie ", "storie"), ("  ", None), (" Photo", "Photo"), (None, None), ("Texte", "Texte")])
def test_post_type_cleaning_order(spark, loaded, want):
    assert col_values(spark, [loaded], clean_post_type) == [want]


def test_reactions_sum_ignores_none_and_source_total(spark):
    df = spark.createDataFrame([(None, None, None, None, 0, 2, None, 5, 99)],
                               "likes int, wow int, sad int, haha int, angry int, love int, thankful int, none int, reactions int")
    assert df.select(reactions_total()).first()[0] == 2


def test_simple_braces(spark):
    assert col_values(spark, ['"TN":3', ' {"TN":3}', "  ", None, ""], simple_braces) == \
        ['{"TN":3}', ' {"TN":3}', "{  }", None, ""]


def test_locale_braces(spark):
    got = col_values(spark, ['{"a":1}}', '{"a":1', '"a":1}', '"a":1', "  ", '{"a":1}', None], locale_braces)
    assert got == ['{"a":1}'] * 4 + [None, '{"a":1}', None]


def test_has_json(spark):
    assert col_values(spark, [None, "", "0", "[]", "{}", "   ", '{"a":1}'], has_json) == \
        [False, False, False, False, False, True, True]


def test_json_entries_keep_duplicates_in_order(spark):
    df = spark.createDataFrame([('{"a":1,"b":null,"a":2,"o":{"x":1}}',)], "x string")
    entries = df.select(json_entries(F.col("x"))).first()[0]
    assert [(e["key"], e["value"]) for e in entries] == [("a", "1"), ("b", None), ("a", "2"), ("o", '{"x":1}')]


def test_video_counters(spark):
    df = spark.createDataFrame([('{"data":{"total_video_views":"7"}}',), ('{"x":1}',), ("[1]",), ("[]",), (None,),
                                ('{"data":{"total_video_views":12.5}}',)], "x string")
    got = [r[0] for r in df.select(video_columns(F.col("x"))["total_video_views"]).collect()]
    assert got == [7, None, None, None, None, None]


def test_safe_int_tolerant_and_strict(spark):
    assert col_values(spark, [" 12 ", "12.0", "x", None], lambda c: to_int(c)) == [12, None, None, None]
    df = spark.createDataFrame([("12.0",)], "x string")
    with pytest.raises(Exception):
        df.select(to_int(F.col("x"), strict=True)).collect()


def test_strip_nul(spark):
    assert col_values(spark, ["a\x00b", None, "ab"], strip_nul) == ["ab", None, "ab"]


def test_strip_nul_strings_keeps_other_types(spark):
    from pagemart.functions import strip_nul_strings
    df = spark.createDataFrame([(1, "a\x00", ["b\x00"])], "n int, s string, a array<string>")
    out = strip_nul_strings(df)
    assert out.columns == df.columns and out.first() == (1, "a", ["b\x00"])
