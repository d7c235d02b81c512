"""Merkle manifest, vector codes and exact top-k: against plain re-computations and DuckDB, with odd rows."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_compare import duck, table_digest
from pagemart.llm import exact_topk, merkle, queries, vector_codes
from pagemart.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_manifest", "op12_codes", "op13_topk"])
def test_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = duck(SF).execute(queries.ORACLE_SQL[name]).df()
    assert table_digest(got)[:3] == table_digest(want)[:3]


# ---- manifest ------------------------------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Root of the nodes, and per node its path of (left, right)."""
    paths, levels, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(levels) > 1:
        for i, j in enumerate(at):
            run = levels[j // 16 * 16:j // 16 * 16 + 16]
            paths[i].append(("".join(run[:j % 16]), "".join(run[j % 16 + 1:])))
        levels = [h(*levels[k:k + 16]) for k in range(0, len(levels), 16)]
        at = [j // 16 for j in at]
    return levels[0], paths


def manifest_by_hand(rows):
    """rows (doc_id, text, lang, source, n_chars) -> sorted result tuples."""
    def leaf(r, lower=False):
        text = r[1] if r[1] is None or not lower else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
        return h(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(text))
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    own = {}
    for s in order:
        own_rows = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        own[s] = (own_rows, *tree([leaf(r) for r in own_rows]))
    root, above = tree([own[s][1] for s in order])
    out = []
    for s, up in zip(order, above):
        for r, path in zip(own[s][0], own[s][2]):
            path = path + up
            node = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0)
            for x, y in path:
                node = h(x, node, y)
            out.append((r[0], leaf(r), own[s][1], root, h(*[x + y for x, y in path]), node, node == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
TYPE = "doc_id long, text string, lang string, source string, n_chars long"


def test_manifest_by_hand(spark):
    rows = [(i, f"Text {i}", "en", "big", 7) for i in range(4200)]                      # a third level of blocks' tops
    rows += [(i, None if i % 3 else "", None, f"s{i % 7}", None) for i in range(5000, 5120)]
    rows += [(9000 + i, "A" * 40_000, "fr", None, 1) for i in range(17)]                 # the null group, long texts
    rows += [(None, "No Id", "en", "s1", 1), (None, "No Id 2", "en", "s1", 1), (5001, "Other", "de", "s3", 2), (8, "x", "en", "", 1)]
    rows += [(77, "Same", "en", "copies", 4)] * 700 + [(7, "é Ünï", "en", "lone", 5)]   # repeated rows, a lone leaf
    docs = spark.createDataFrame(rows, TYPE)
    want = manifest_by_hand(rows)
    for conf in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", conf)                              # without it every partition is used
        try:
            got = merkle.tamper_check(docs.repartition(7)).select(*COLUMNS).collect()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert sorted(map(tuple, got), key=repr) == want


@pytest.mark.parametrize("n", [0, 1, 16, 17, 257])
def test_manifest_sizes(spark, n):
    rows = [(i, "T", "en", "s", 1) for i in range(n)]
    got = merkle.tamper_check(spark.createDataFrame(rows, TYPE)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == (manifest_by_hand(rows) if n else [])


def test_manifest_path_and_clashing_names(spark, docs_of):
    docs = docs_of([(i, f"t{i}", "ab"[i % 2]) for i in range(40)])
    clash = docs.select("*", *[F.lit("!").alias(c) for c in ("g", "pos", "n", "digest", "x", "up", "path", "leaf", "c", "row", "pid", "items")])
    plain, odd = (sorted(merkle.manifest(d).collect(), key=lambda r: r.doc_id) for d in (docs, clash))
    assert plain == odd and [r.doc_id for r in plain] == list(range(40))
    again = merkle.manifest(docs).withColumn("back", merkle.fold(F.col("leaf"), F.col("path")))
    assert again.where("back <> root").count() == 0
    assert "Python" not in merkle.tamper_check(docs)._jdf.queryExecution().toString()


# ---- vector codes --------------------------------------------------------------------------------

def codes_by_hand(rows):
    """rows (id, ints, label) of one length, ascending ids -> (code, error) per row and the codebooks."""
    width = len(rows[0][1])
    x = np.array([r[1] for r in rows], dtype=object)
    cut = [width * p // 4 for p in range(5)]
    codes, errors, books = [], 0, []
    for a, b in zip(cut, cut[1:]):
        p = x[:, a:b]
        book = [list(v) for v in p[:256]]
        for last in [False] * 4 + [True]:
            d = [[sum((int(u) - int(w)) ** 2 for u, w in zip(v, e)) for e in book] for v in p]
            near = [row.index(min(row)) for row in d]
            if last:
                break
            for e in set(near):
                own = [v for v, n in zip(p, near) if n == e]
                book[e] = [sum(int(v[i]) for v in own) // len(own) for i in range(b - a)]
        codes.append(near)
        errors = errors + np.array([min(row) for row in d], dtype=object)
        books += [v for e in book for v in e]
    text = ",".join(map(str, books))
    return ["".join(f"{c:02x}" for c in r) for r in zip(*codes)], errors, hashlib.sha256(text.encode()).hexdigest()


def test_codes_by_hand_with_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * 3).tolist(), i % 3 if i % 4 else None) for i in range(1, 330)]    # six components: uneven parts
    rows += [(400 + i, rows[0][1], 1) for i in range(90)] + [(500, [0.0] * 6, None)]
    one = [(-5, [1.0, 2.0, 3.0], 9), (-4, [-1.0, 0.5, 3.0], 9)]                                          # another length, smallest ids
    far = [(600, [1e30, -1e30, 0.0, 0.0, 0.0, 1.0, 5.0, 2.0], 8), (601, [3.0] * 8, 8), (602, [-4e9] * 8, 8)]
    bad = [(2, None, 1), (3, [float("nan")] * 6, 1), (4, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (5, [float("inf")] * 6, 1)]
    df = spark.createDataFrame([(i, v, k, "?", "?") for i, v, k in rows + one + far + bad + [(900, [], 7)]],
                               "vec_id long, embedding array<double>, label int, k string, ints string")
    coded, books = vector_codes.compress(df.repartition(5))
    got = {r.vec_id: r for r in coded.collect()}
    assert sorted(books) == [0, 3, 6, 8] and got[900].code == "00000000" and got[900].error == 0

    def ints(rows):
        hold = lambda v: max(min(v, 2 ** 63 - 1), -2 ** 63)
        return [(i, [hold(math.floor(1024 * x)) for x in v], k) for i, v, k in rows]
    error = {}
    for part in (rows, one, far):
        code, errors, sha = codes_by_hand(ints(part))
        for (i, _, k), c, e in zip(part, code, errors):
            e = min(e, 2 ** 63 - 1)
            assert (got[i].code, got[i].error, got[i].codebooks_sha256) == (c, e, sha), i
            error[k] = error.get(k, 0) + e
    assert all(r.label_error == min(error.get(r.label, 0), 2 ** 63 - 1) for r in got.values())
    assert coded.count() == len(rows) + len(one) + len(far) + 1
    assert vector_codes.compress(df.limit(0))[0].count() == 0


def test_cells_leave_out_and_remember(spark):
    rng = np.random.default_rng(1)
    entries = rng.integers(-400, 400, size=(256, 4))
    parts = rng.integers(-400, 400, size=(300, 4))
    book = vector_codes.Codebook(entries)
    near, best = book.nearest(np.concatenate([parts, parts]))
    d = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert (near[:300] == d.argmin(1)).all() and (best[300:] == d.min(1)).all()
    assert book.met <= 300 and book.compared < 0.1 * 600 * 256          # repeated parts meet known cells, few entries are left


# ---- exact top-k ---------------------------------------------------------------------------------

def topk_by_hand(rows, k=5):
    out = []
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {(i, tuple(v)) for i, v in ok if i is not None and i % 50 == 0}
    for q, v in asked:
        held = lambda w: max(min(sum(a * b for a, b in zip(v, w)), 2 ** 63 - 1), -2 ** 63)
        scored = sorted((-held(w), c is None, c or 0) for c, w in ok if c != q and len(w) == len(v))
        out += [(q, n, None if none else c, -s) for n, (s, none, c) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def run_topk(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "?") for i, v in rows], "vec_id long, embedding array<double>, width int, slab string")
    return sorted(map(tuple, exact_topk.search(df.repartition(3), F.col("vec_id") % 50 == 0).collect()), key=repr)


def test_topk_by_hand(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=20).tolist()) for i in range(2600)]
    rows += [(3000 + i, rows[50][1]) for i in range(40)] + [(5000, [0.0] * 20), (None, rows[50][1]), (100, rows[7][1]), (150, rows[150][1])]
    rows += [(-100, [1.0, 2.0]), (7000, [-1.0, 0.5]), (7001, [3.0, 3.0]), (7050, [])]
    rows += [(7002, None), (7100, [float("nan")] * 20), (7003, [None] + [1.0] * 19)]
    assert run_topk(spark, rows) == topk_by_hand(rows)


def test_topk_large_and_few(spark):
    far = [(0, [3e15, -2e15, 1e14]), (1, [1e15, 1e15, 0.0]), (2, [-2e15, 2e15, 1e10]), (50, [1e3, 1e3, 1.0])]
    assert run_topk(spark, far) == topk_by_hand(far)
    assert run_topk(spark, [(50, [1.0])]) == [] and run_topk(spark, []) == [] and run_topk(spark, [(1, [1.0])]) == []


def test_topk_bounds_leave_out():
    rng = np.random.default_rng(2)
    cand = (rng.normal(size=(4096, 64)) * 30 / np.sqrt(1 + np.arange(64))).astype(int)
    q = exact_topk.Query(0, None, cand[0] * 2, 5)
    q.meet(exact_topk.Columns(np.arange(4096), np.ascontiguousarray(cand.T)))
    score = cand @ (cand[0] * 2)
    assert sorted(s for s, _ in q.best) == sorted(score.tolist())[-5:]
    assert q.read < 0.6 * cand.size


def test_inputs_are_whole_tables(spark):
    n = read_table(spark, SF, "embeddings").count()
    assert queries.op12_codes(spark, SF).count() == n
    assert queries.op13_topk(spark, SF).select("query_id").distinct().count() == n // 50
