"""Page extraction, quality rules, classifier, tokens and pieces."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from pagemart.llm import html_extract, lattice, nbsvm, queries, token_counts, weak_rules
from pagemart.llm.common import read_table

SF = "/root/testdata/sf0.001"

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><a href=/>Home</a><h2>Site name</h2></header><nav><ul><li><a href=a>A</a></ul></nav>
<div class="cookie-notice">We use cookies, really, lots, of them, on this, page.</div>
<div class="wrapper"><div class="post-content"><h1>Title</h1><p>First paragraph, with commas, and more text, long enough.
<p>Second&nbsp;&amp; third <b>bold</b><br>line.</p><ul><li>one<li>two</ul><!-- <p>no</p> --><script>var a = "<p>no</p>";</script>
<aside>Aside, text, here.</aside><form><p>Sign up, please.</p></form><p class="ad">Buy, now.</p><p hidden>no</p></div>
<div class="sidebar"><p>Side text, with, commas, many, many, of them, in here, too, and so on.</p></div>
<section id="comments"><p>I like it, very, very, much, indeed, so much that I comment, at length.</p></section></div>
<footer>&copy; x</footer></body></html>"""


ARTICLE = "\n".join(["Title", "First paragraph, with commas, and more text, long enough.", "Second & third bold line.", "one", "two"])


def test_extracts_the_article():
    assert html_extract.main_text(PAGE) == ARTICLE


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<article><h1>H</h1><p>a <p>b</article><p>out", "H\na\nb"),
    ("<p>a<b>b</p><p>c</b> d", "ab\nc d"), ("<div>x <a title='p>q' href=z>l</a></div>", "x l"), ("<p>1 < 2 && 3 > 2</p>", "1 < 2 && 3 > 2"),
    ("<p>a<br><br>b</p>", "a\nb"), ("<script>x", ""), ("<p>&#65;&#x42;&eacute;&bogus;</p>", "ABé&bogus;"), ("<![CDATA[a&b]]>", "a&b"),
    ("<main><article><p>Body text, that counts.</p></article></main><article class='comment'><p>Nice, one.</p></article>", "Body text, that counts."),
])
def test_markup_cases(html, text):
    assert html_extract.main_text(html) == text


def test_deep_and_long_pages():
    assert html_extract.main_text("<div>" * 20000 + "<p>deep, text</p>") == "deep, text"
    long = "<article>" + "".join(f"<p>para {i}, with text</p>" for i in range(20000)) + "</article>"
    assert html_extract.main_text(long).count("\n") == 19999


def test_extract_rows(spark):
    rows = [(1, "u", PAGE, "x"), (2, "u", None, "y"), (2, "u", "", "z"), (None, None, "<p>a</p>", None)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [(r.page_id, r.n_chars, len(r.text)) for r in got] == [(1, len(ARTICLE), len(ARTICLE)), (2, 0, 0), (2, 0, 0), (None, 1, 1)]
    assert queries.op1_extract(spark, SF).where("n_chars = 0 OR text LIKE '%<%'").count() == 0


# ---- quality rules -----------------------------------------------------------------------------

def plain_counts(text):
    import re
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", text) if x]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines, dup, seen = text.split("\n"), 0, set()
    for x in lines:
        if re.search(r"[^\x20\x09-\x0d]", x):
            dup += x in seen
            seen.add(x)
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


def test_counts_equal_brute_force():
    rng = random.Random(4)
    texts = ["", " \n\t ", "a", "a b c a b c", "x\nx\n \n \nx", "é ü# <b> é ü# <b>", "a a a a a", "\x0b\x0c a\x85b\xa0c"]
    texts += [" ".join(rng.choice("ab cd é# <x> \n").strip() or "\n" for _ in range(60)) for _ in range(40)]
    for t in texts:
        assert weak_rules.text_stats(t.encode())[:5] == plain_counts(t), t


def test_em_separates_and_finds_the_bad_rule():
    rng = np.random.default_rng(1)
    bad = rng.random(4000) < 0.15
    votes = np.ones((4000, 4), dtype=int)
    for j, (hit, false) in enumerate([(0.6, 0.001), (0.5, 0.002), (0.4, 0.0), (0.0, 0.0)]):
        votes[rng.random(4000) < np.where(bad, hit, false), j] = -1
    votes[rng.random((4000, 4)) < 0.1] = 0
    patterns, which, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    p, share, prior = weak_rules.fit_accuracies(patterns, n.astype(float))
    kept = p[which.ravel()] >= 0.5
    caught = (votes == -1).any(1)
    assert kept[~bad & ~caught].all() and not kept[bad & caught].any() and 0.7 < prior < 0.95
    assert share[0, 0] > share[0, 3] and (share[1] <= 0.01).all()


def test_weak_quality_keeps_labelled_good(spark, docs_of):
    docs, labels = read_table(spark, "/root/testdata/sf0.01", "documents"), read_table(spark, "/root/testdata/sf0.01", "labels")
    m = weak_rules.weak_quality(docs).join(labels, "doc_id").where("NOT base_failed").toPandas()
    assert m[m.quality == 1].kept.mean() > 0.99 and m[m.quality == 0].kept.mean() < 0.05
    got = {r.doc_id: r for r in weak_rules.weak_quality(docs_of([(1, None), (2, ""), (3, "a b " * 40), (4, None)])).collect()}
    assert all(r.base_failed and not r.kept for r in got.values()) and got[3].n_repeat_words == 80
    assert weak_rules.weak_quality(docs_of([])).count() == 0


# ---- classifier --------------------------------------------------------------------------------

def test_classifier_held_out_accuracy(spark):
    got = queries.op7_quality(spark, "/root/testdata/sf0.01").join(read_table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 80 and (held.predicted == held.quality).mean() > 0.97
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 30, 8)).astype(np.int32) for _ in range(60)]
    y = np.array([1 if 3 in r or 5 in r else -1 for r in rows])
    ratio = np.where(np.arange(nbsvm.DIMENSIONS) < 30, 1.0, 0.0)
    w, b = nbsvm.dual_coordinate_descent(rows, ratio, y, epochs=400)

    def loss(w_, b_):
        return 0.5 * (w_ @ w_ + b_ * b_) + sum(max(0, 1 - k * (w_[r].sum() / len(r) ** 0.5 + b_)) for r, k in zip(rows, y))
    best = loss(w, b)
    for _ in range(200):
        step = np.zeros_like(w)
        step[:30] = rng.normal(0, 0.02, 30)
        assert loss(w + step, b + rng.normal(0, 0.02)) >= best - 1e-3


def test_classifier_without_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = nbsvm.classify(docs_of([(1, None), (2, ""), (None, "a b"), (1, None)]), none).collect()
    assert [r.score for r in got] == [0.5] * 4 and all(r.predicted == 1 for r in got)
    one = spark.createDataFrame([(1, 1, 0), (2, None, 0), (2, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert nbsvm.classify(docs_of([]), one).count() == 0


# ---- token counts ------------------------------------------------------------------------------

def test_allocation_rule_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        cut = np.unique(rng.integers(0, n + 1, 6))
        spans = [(a, b) for a, b in zip(np.r_[0, cut], np.r_[cut, n]) if rng.random() < 0.8] or [(0, n)]
        tok = np.unique(np.r_[0, rng.integers(0, n + 1, 9), n])
        s, e = tok[:-1], tok[1:]
        a, b = (np.array([x[k] for x in spans]) for k in (0, 1))
        owner, crosses = token_counts.allocate(s, e, a, b)
        for i in range(len(s)):
            share = [min(b[k], e[i]) - max(a[k], s[i]) for k in range(len(a))]
            if max(share) > 0:
                k = int(np.argmax(share))
                assert owner[i] == k and crosses[i] == (s[i] < a[k] or e[i] > b[k])
            else:
                assert owner[i] == max([k for k in range(len(a)) if a[k] <= s[i]], default=0) and not crosses[i]


def test_section_tokens_add_up(spark, docs_of):
    enc = token_counts.Encoder(open(token_counts.RANKS, "rb").read())
    texts = [None, "", "One sentence. Another, né 日本語!  Third\nline\n\n\nend 😀", "a" * 5000, " \n "]
    got = token_counts.section_tokens(docs_of(list(enumerate(texts)))).toPandas()
    for i, t in enumerate(texts):
        rows = got[got.doc_id == i].sort_values("section")
        assert rows.n_tokens.sum() == len(enc.encoding.encode_ordinary(t or ""))
        assert list(rows.start) == [0, *rows.end[:-1]] and rows.end.iloc[-1] == len(t or "")
    assert token_counts.section_tokens(docs_of([])).count() == 0 and got.n_crossing.sum() > 0


def test_long_white_space(spark, docs_of, monkeypatch):
    enc = token_counts.Encoder(open(token_counts.RANKS, "rb").read())
    texts = ["a" + ws * n + tail for ws in (" ", "\n", " \t\u3000", "\u200b") for n in (1, 2, 3, 4, 7, 40) for tail in ("", "b", "7 x", "!", "'s")]
    want = [enc.encoding.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(token_counts, "LONG_RUN", 3)
    assert [enc.encode(t) for t in texts] == want
    monkeypatch.undo()
    got = token_counts.section_tokens(docs_of([(1, "one." + " " * 2_000_000 + "two"), (2, " " * 2_000_000)])).toPandas()
    few = len(enc.encoding.encode_ordinary("one." + " " * 100 + "two"))
    assert got[got.doc_id == 1].n_tokens.sum() == few + 2_000_000 - 100 and got[got.doc_id == 1].end.max() == 2_000_007
    assert got[got.doc_id == 2].n_tokens.sum() == 2_000_000


# ---- pieces ------------------------------------------------------------------------------------

PROBES = ["", None, "a", " a", "hello  world", "x\ny", "日本語テキスト です", "\x00a", "é", "a\r\n", "ACGT" * 60, "naïve café — “quotes” 12,345.67!!!   end ",
          "<s> </s> <0x0A>", "😀😀 ok", "▁x", "  ", "\n\n", "x² ½ Ⅷ ²."]


@pytest.mark.parametrize("block", [lattice.BLOCK_BYTES, 50])
def test_pieces_equal_the_model(docs_of, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK_BYTES", block)
    monkeypatch.setattr(lattice, "SLICE_UNITS", block)
    sp = sentencepiece.SentencePieceProcessor(model_file=lattice.MODEL)
    got = lattice.decode(lattice.encode(docs_of([(i, t) for i, t in enumerate(PROBES * 4)]))).collect()
    assert len(got) == 4 * len(PROBES)
    for r in got:
        assert list(r.ids) == sp.encode(r.text or "") and r.n_tokens == len(r.ids), r.text
        assert r.decoded == (r.text or "").replace("▁", " ")


def test_round_trip_of_a_table(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=lattice.MODEL)
    docs = read_table(spark, SF, "documents").select("doc_id", "text")
    got = lattice.decode(lattice.encode(docs)).toPandas()
    assert len(got) == docs.count() and (got.decoded == got.text).all()
    assert all(list(i) == sp.encode(t) for i, t in zip(got.ids, got.text))


def test_pieces_of_an_empty_table_and_clashing_names(docs_of):
    assert lattice.encode(docs_of([])).count() == 0
    docs = docs_of([(1, "one two"), (2, None)])
    names = ["block", "word", "kind", "rows", "c0", "c1", "piece", "edges", "n", "ids"]
    odd = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    got = lattice.encode(odd, decoded="back", drop_text=True).orderBy("doc_id").collect()
    assert [(r.doc_id, r.back, *(r[c] for c in names[:-1])) for r in got] == [(i, t, *(f"own {c}" for c in names[:-1])) for i, t in ((1, "one two"), (2, ""))]
    assert got[0].n_tokens == len(got[0].ids) > 0 and "text" not in got[0]


def test_numbered_words_equal_the_split_texts():
    texts = [t or "" for t in PROBES] + ["one two, three", "two  one", "Straße — 12 three.", "x" * 300 + " one"]
    random.Random(5).shuffle(texts)
    codes, lengths, words = lattice._numbered(pa.array(texts, pa.string()))
    words, ends = words.to_pylist(), np.cumsum(lengths)
    assert len(set(words)) == len(words) and [[words[c] for c in codes[e - n:e]] for e, n in zip(ends, lengths, strict=True)] == [lattice.words_of(t) for t in texts]
    assert lattice._numbered(pa.array([], pa.string()))[0].tolist() == []


def test_packed_words_come_back():
    words = pa.array([" one", " zwölf", "日本", " one more"] * 50 + ["y" * 61, "z" * 5000], pa.string())
    lengths, data = lattice._unpressed(lattice._pressed(*lattice._parts(words.slice(1))))
    assert lattice._strings(lengths, data, pa.string()).equals(words.slice(1))
    assert (lattice._buckets(words, 7)[1:] == lattice._buckets(words.slice(1), 7)).all() and set(lattice._buckets(words, 7)) <= set(range(7))
    asked = list(lattice._asked(words, 7))
    assert sorted(i for _, at, _ in asked for i in at) == list(range(200))        # long words are not asked for
    assert all(lattice._strings(*x, pa.string()).equals(words.take(pa.array(at))) for _, at, x in asked)


def test_pieces_move_no_row_per_word_and_block(spark, docs_of):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(6000)]
    docs = docs_of([(i, " ".join(rng.sample(words, len(words)))) for i in range(16)]).repartition(8).select("doc_id", "text")
    got = lattice.encode(docs, decoded="back")
    assert all(r.back == r.text for r in got.collect())
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    final = plan[:plan.index("Initial Plan")]
    rows = [float(x) for x in re.findall(r"ShuffleQueryStage .*rowCount=([0-9.E+]+)", final)]
    assert rows and sum(rows) < 6 * len(words)           # a row for each of 8 blocks' words, asked and answered, would be 16 times as many
    assert "REPARTITION_BY_NUM" in plan                  # the lattice's partitions are not put together


def test_splitting_a_block_takes_little_memory():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz.,", k=7)) for _ in range(200_000)]
    texts = pa.array([" ".join(words[i:i + 1000]) for i in range(0, len(words), 1000)])
    tracemalloc.start()
    lattice._numbered(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6       # lists of words per unit took 40 MB, this 23
