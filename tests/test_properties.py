"""Property tests: Spark expressions against small Python statements of the same rules, on
generated inputs (each example is one batch of strings, so one Spark job per example)."""

from __future__ import annotations

import json
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemart.functions import blank_to_null, initcap_words, locale_braces, simple_braces
from pagemart.operators import explode_json_object

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

TEXT = st.text(alphabet=st.sampled_from(list("aZé9 _-#'{}\":,.\tÀ1x")), max_size=12)


def py_initcap(s: str) -> str:
    out, prev_alnum = [], False
    for ch in s.lower():
        alnum = unicodedata.category(ch)[0] in "LN"
        out.append(ch.upper() if alnum and not prev_alnum else ch)
        prev_alnum = alnum
    return "".join(out)


def py_locale(s):
    if s is None or s.strip(" ") == "":
        return None
    t = s.strip(" ")
    starts, ends = t[:1] == "{", t[-1:] == "}"
    if starts and t[-2:] == "}}":
        return t[:-1]
    if starts and ends:
        return t
    if not starts and ends:
        return "{" + t
    if starts and not ends:
        return t + "}"
    return "{" + t + "}"


def py_simple(s):
    if s is not None and s != "" and s.strip(" ")[:1] != "{":
        return "{" + s + "}"
    return s


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in df.select("i", expr(F.col("x"))).orderBy("i").collect()]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_initcap_matches_word_rule(spark, values):
    assert run(spark, values, initcap_words) == [py_initcap(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=40))
def test_brace_repairs(spark, values):
    assert run(spark, values, locale_braces) == [py_locale(v) for v in values]
    assert run(spark, values, simple_braces) == [py_simple(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=40))
def test_blank_to_null(spark, values):
    want = [None if v is None or v.strip(" ") == "" else v.strip(" ") for v in values]
    assert run(spark, values, blank_to_null) == want


KEYS = st.sampled_from(["TN", "FR", " TN", "a", "b", "Paris, FR"])


@SETTINGS
@given(st.lists(st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(0, 99))), max_size=8), min_size=1, max_size=20))
def test_explode_first_key_wins(spark, objects):
    texts = ["{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in obj) + "}" for obj in objects]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = sorted((r.i, r.key, r.value) for r in explode_json_object(df, F.col("t"), ["i"], "key").collect())
    want = []
    for i, obj in enumerate(objects):
        seen = {}
        for k, v in obj:
            seen.setdefault(k, None if v is None else str(v))
        want += [(i, k, v) for k, v in seen.items()]
    assert got == sorted(want, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or ""))


TYPES = st.one_of(st.none(), st.sampled_from(["", "storie", " storie ", "Photo", " Video ", "  ", "x"]))
URLS = st.one_of(st.none(), st.sampled_from(["/reel/1", "/reel/", "/p/1", "", "x/reel/"]))
STATUSES = st.one_of(st.none(), st.sampled_from(["", "added_photos", "added_video", "mobile_status_update",
                                                 "shared_story", "storie_photo", "storie_video", "other"]))


def py_post_type(t, u, s):
    if t not in (None, ""):
        label = t
    elif u is not None and u.startswith("/reel/"):
        label = "Reels"
    elif s in ("added_photos",):
        label = "Photo"
    elif s == "added_video":
        label = "Video"
    elif s == "mobile_status_update":
        label = "Reels"
    elif s in ("shared_story", "storie_photo", "storie_video"):
        label = "Story"
    elif s in (None, ""):
        label = "Texte"
    else:
        label = None
    # cleaning: exact 'storie' renamed first, then trimmed, blank -> NULL
    if label == "storie":
        label = "Story"
    if label is not None:
        label = label.strip(" ") or None
    return label


@SETTINGS
@given(st.lists(st.tuples(TYPES, URLS, STATUSES), min_size=1, max_size=60))
def test_post_type_truth_table(spark, rows):
    from pagemart.functions import clean_post_type, post_type
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, u string, s string")
    got = [r[0] for r in df.orderBy("i").select(clean_post_type(post_type(F.col("t"), F.col("u"), F.col("s")))).collect()]
    assert got == [py_post_type(*r) for r in rows]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([1, 2, 3, 4]), st.one_of(st.none(), st.integers(0, 1))), min_size=1,
                max_size=40))
def test_deleted_post_precedence(spark, rows):
    from pagemart.plans import ods
    clients = "id int, name string, social_type string, type string, picture string, actif int, managed int"
    # page 1 managed, page 2 unmanaged, page 3 on both lists, page 4 on none
    managed = spark.createDataFrame([(1, "a", "facebook", "", "", 1, 1), (3, "c", "facebook", "", "", 1, 1)], clients)
    unmanaged = spark.createDataFrame([(2, "b", "facebook", "", "", 1, 0), (3, "c", "facebook", "", "", 1, 0)], clients)
    posts = spark.createDataFrame([(i, page, deleted) for i, (page, deleted) in enumerate(rows)],
                                  "id long, page_id int, is_deleted int")
    for c in ("social_type", "type", "url", "status_type", "message", "is_real", "post_clicks_by_type", "data"):
        posts = posts.withColumn(c, F.lit(None).cast("string"))
    for c in ("likes", "wow", "sad", "haha", "angry", "love", "thankful", "comments", "shares", "views", "clicks",
              "reach", "reach_organic", "reach_paid"):
        posts = posts.withColumn(c, F.lit(None).cast("int"))
    posts = posts.withColumn("creation_time", F.lit(None).cast("timestamp_ntz"))
    pages = ods.eligible_pages(managed, unmanaged)
    got = sorted(r.post_id for r in ods.ods_posts(posts, pages).collect())
    in_m, in_u = {1, 3}, {2, 3}
    want = sorted(i for i, (page, deleted) in enumerate(rows)
                  if (deleted == 0 and page in in_m) or page in in_u)
    assert got == want
