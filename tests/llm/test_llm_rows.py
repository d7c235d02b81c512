"""Source mixing, neighbour search and the pipeline."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle_compare import duck, table_digest
from pagemart.llm import ann, mixing, queries
from pagemart.llm.common import read_table

SF = "/root/testdata/sf0.001"


def test_mix_equals_sql(spark):
    got = queries.op8_mix(spark, "/root/testdata/sf0.01").toPandas()
    want = duck("/root/testdata/sf0.01").execute(queries.ORACLE_SQL["op8_mix"]).df()
    assert table_digest(got)[:3] == table_digest(want)[:3]
    assert "Python" not in mixing.mix(read_table(spark, SF, "documents"))._jdf.queryExecution().toString()


def fill(sizes):
    """The rule step by step: share by weight, stop at three times the size, reshare what is over."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sizes)}
    target = dict.fromkeys(sizes, 0.0)
    left, free = float(sum(sizes.values())), set(sizes)
    while left > 1e-9 and free:
        total = sum(weights[s] for s in free)
        add = {s: left * weights[s] / total for s in free}
        left = 0.0
        for s in list(free):
            target[s] += add[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                free.discard(s)
    return target


def test_mix_targets_and_takes(docs_of):
    rows, n = [], 0
    for s, k in (("a", 2), ("b", 40), ("c", 60), ("d", 1), ("é", 30), (None, 25)):
        for j in range(k):
            rows.append((n, "w " * (1 + (n * 7) % 11) + ("#" if j % 5 == 0 else ""), s))
            n += 1
    rows += [(n, None, "b"), (n + 1, "", "z"), (rows[5][0], rows[5][1], rows[5][2]), (None, "x y", "c")]
    got = mixing.mix(docs_of(rows)).toPandas()
    again = mixing.mix(docs_of(rows)).toPandas()
    assert table_digest(got)[2] == table_digest(again)[2] and len(got) == len(rows)
    size = lambda t: len((t or "").split())
    order = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(size(t) for _, t, x in rows if x == s) for s in order}
    target = fill(sizes)
    for s, total in sizes.items():
        own = got[(got.source_size == total) & np.isclose(got.target, target[s])]
        assert len(own) >= sum(r[2] == s for r in rows), s
    assert (got.taken <= 3 * got["size"]).all() and (got.taken == got.copies * got["size"]).all()
    assert abs(got.taken.sum() - sum(sizes.values())) <= 12 * len(order)
    assert mixing.mix(docs_of([])).count() == 0


def test_mix_prefers_quality(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                    F.when(F.col("id") % 2 == 0, F.lit("x")).otherwise(F.lit("y")).alias("source"))
    good = F.when(F.col("doc_id") % 4 == 1, F.lit(1.0)).otherwise(F.lit(0.2))
    taken = mixing.mix(docs, weight=good).where("doc_id % 2 = 1").groupBy((F.col("doc_id") % 4 == 1).alias("good")).agg(F.sum("taken").alias("t")).collect()
    share = {r.good: r.t for r in taken}
    assert share[True] > 1.4 * share[False]


# ---- neighbours --------------------------------------------------------------------------------

def exact(ids, x, q, k):
    s = np.array([math.dist(v, x[q]) for v in x])
    order = [i for i in np.lexsort((ids, s)) if i != q][:k]
    return [(int(ids[i]), s[i]) for i in order]


def test_recall_on_the_table(spark):
    got = queries.op9_neighbours(spark, "/root/testdata/sf0.1").toPandas()
    e = read_table(spark, "/root/testdata/sf0.1", "embeddings").toPandas()
    ids, x = e.vec_id.to_numpy(), np.stack(e.embedding).astype(float)
    hits = 0
    asked = np.flatnonzero(ids % 100 == 0)
    for q in asked:
        own = got[got.query_id == ids[q]].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 11)) and own.score.is_monotonic_increasing
        hits += len({v for v, _ in exact(ids, x, q, 10)} & set(own.vec_id))
    assert hits / (10 * len(asked)) >= 0.9 and got.query_id.nunique() == len(asked)


def test_exact_with_copies_blocks_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 16)
    monkeypatch.setattr(ann, "CHUNK_ROWS", 2)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5))
    x[100:200] = x[100]                      # a third of the rows are one vector
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(1000, None), (1100, [0.0] * 5), (1200, [1.0, None, 0.0, 0.0, 0.0]), (1300, [float("nan")] * 5), (1400, [math.inf] * 5), (None, [1.0] * 5),
             (1500, []), (1600, [1.0]), rows[7]]
    got = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect()
    ids = np.arange(300)
    for q in (0, 100, 200):
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [(v, pytest.approx(s, abs=1e-12)) for _, v, s in own] == exact(ids, x, q, 10)
    assert {r.query_id for r in got} == {0, 100, 200}


def test_recall_with_several_hundred_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 50)
    n = 16_000                                      # 320 lists
    x = np.random.default_rng(9).normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]         # no cluster structure: the hardest case
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": x.tolist()}))
    got = ann.nearest_neighbours(table, F.col("vec_id") % 200 == 0).toPandas().groupby("query_id").vec_id.agg(set)
    hits = [len(set(np.argsort(((x - x[q]) ** 2).sum(1))[1:11]) & got[q]) for q in range(0, n, 200)]
    assert np.mean(hits) / 10 >= 0.98


@pytest.mark.parametrize("shift, clusters, size", [(0, 60, 16), (1e8, 0, 8), (1e6, 60, 64)])
def test_recall_of_clustered_and_shifted_vectors(spark, monkeypatch, shift, clusters, size):
    monkeypatch.setattr(ann, "LIST_ROWS", 10)
    n = 3000                                        # 300 lists
    rng = np.random.default_rng(9)
    x = rng.normal(size=(n, size)) + (3 * rng.normal(size=(clusters, size))[rng.integers(0, clusters, n)] if clusters else 0) + shift
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(-100, [1.0]), (-99, [2.0]), (-98, [2.5, 1.0])]      # other lengths at the smallest ids
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest_neighbours(table, F.col("vec_id") % 100 == 0).toPandas().groupby("query_id").vec_id.agg(set)
    hits = [len(set(np.argsort(((x - x[q]) ** 2).sum(1), kind="stable")[1:11]) & got[q]) for q in range(0, n, 100)]
    assert np.mean(hits) / 10 >= 0.95 and got[-100] == {-99} and len(got) == 31


def test_budget_of_lists_follows_the_data():
    rng = np.random.default_rng(2)
    sizes = []
    for clusters in (400, 0):
        x = rng.normal(size=(4000, 16)) + (20 * rng.normal(size=(clusters, 16))[rng.integers(0, clusters, 4000)] if clusters else 0)
        sizes.append(ann.search_bounds(x, ann.CentroidGraph.build(ann.balanced_centroids(x, 200)))[0])
    assert sizes[0] < 0.3 * sizes[1] and sizes[1] <= 200


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.nearest_neighbours(spark.createDataFrame([], schema), F.col("vec_id") % 100 == 0).count() == 0
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0])], schema)
    got = ann.nearest_neighbours(three, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 1.0), (2, 1.0)]


def test_graph_search_finds_near_centroids():
    rng = np.random.default_rng(6)
    c = ann.balanced_centroids(rng.normal(size=(4000, 8)), 300)
    graph = ann.CentroidGraph.build(c)
    x = rng.normal(size=(50, 8))
    found, dist = graph.search(x, 5)
    true = np.argsort(ann._distances(x, c), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(found, true)]) > 0.95
    assert np.allclose(dist[:, 0], np.sqrt(ann._distances(x, c).min(1)), atol=1e-6)


# ---- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = read_table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "SentencePiece encoding and decoding"]
    frames = [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, SF), "test")
        frames.append(docs.toPandas())
    raw, good, freed, single, mixed, pieces = frames
    assert all(list(f.columns) == list(raw.columns) for f in frames[:-1])
    quality = read_table(spark, SF, "labels").toPandas()
    bad = set(quality[quality.quality == 0].doc_id)
    assert set(good.doc_id) <= set(raw.doc_id) and len(bad & set(good.doc_id)) <= 0.1 * len(bad)
    fine = set(quality[quality.quality == 1].doc_id) & set(raw.doc_id)
    assert len(fine - set(good.doc_id)) <= 0.03 * len(fine)      # about 60 documents teach here
    assert sorted(freed.doc_id) == sorted(good.doc_id) and (freed.n_chars == freed.text.str.len()).all()
    assert single.doc_id.is_unique and set(single.doc_id) <= set(freed.doc_id)
    assert mixed.groupby("doc_id").size().max() <= 3 and set(mixed.doc_id) <= set(single.doc_id)
    assert len(pieces) == len(mixed) and sorted(pieces.decoded) == sorted(mixed.text)


def test_pipeline_takes_odd_rows(spark, docs_of):
    rows = [(None, "a b"), (None, None), (1, None), (1, None), (2, ""), (3, "x " * 50), (3, "x " * 50)]
    docs = docs_of(rows)
    near = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in near) == [(False, 1), (False, 3), (True, 0)]
    assert corpus_pipeline.line_dedup_stage(spark, docs, SF).count() == len(rows)
    mixed = corpus_pipeline.source_mix(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.where("text LIKE 'x%'").count() >= 2
    assert corpus_pipeline.pieces(spark, docs, SF).count() == len(rows)
    assert isinstance(corpus_pipeline.run, type(fill)) and pd.DataFrame(corpus_pipeline.STAGES).shape == (5, 2)


def test_clashing_names(spark, docs_of):
    from pagemart.llm import line_dedup, span_dedup
    text = "First line of a passage.\nSecond line of the same passage, which has some more words to be long enough."
    docs = docs_of([(1, text + "\nown end"), (2, "own start\n" + text), (3, "w " * 5)])
    names = ["left", "lines", "gone", "k_id", "k_text", "spans", "place", "col", "copies", "m_id", "m_text", "epoch", "n", "h", "start", "own_0", "size", "key", "slice"]
    odd = docs.select(*[F.lit(f"own {c}").alias(c) for c in names], "*")
    for run in (lambda d: line_dedup.deduplicate_lines(d, overlapping=True), span_dedup.remove_repeated_spans,
                *(lambda d, f=f: f(spark, d, SF) for f in (corpus_pipeline.line_dedup_stage, corpus_pipeline.near_duplicates, corpus_pipeline.source_mix))):
        want, got = run(docs), run(odd)
        assert got.columns == [*names, *want.columns]
        rows = got.collect()
        assert all(r[c] == f"own {c}" for r in rows for c in names)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_pipeline_keeps_one_of_every_group(spark, docs_of):
    def text(word):
        return " ".join(f"{word}{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("a")), (None, text("b")), (None, text("c")), (4, text("c")),     # a and b have no ids
            (5, text("d")), (5, text("e")), (5, text("e")), (6, text("e")), (None, None), (7, "")]
    near = corpus_pipeline.near_duplicates(spark, docs_of(rows), SF)
    want = [(None, text("a")), (None, text("b")), (4, text("c")), (5, text("d")), (5, text("e")), (7, "")]
    assert sorted((r.doc_id or 0, r.text) for r in near.collect()) == sorted((i or 0, x) for i, x in want)
    assert near.columns == docs_of(rows).columns


def test_python_workers_give_memory_back(monkeypatch):
    import pyarrow as pa
    from pagemart.llm import common
    calls, sent = [], {}

    class Pool:
        def release_unused(self):
            calls.append(1)

    class Frame:
        def mapInArrow(self, run, schema):      # noqa: N802  as Spark names it
            sent["run"] = run
    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    common.map_batches(Frame(), lambda b: b, "")
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], names=["a"]) for i in range(3)]
    assert list(sent["run"](iter(batches))) == batches and len(calls) == 4


def test_workers_hold_few_texts_as_python_objects(spark):
    import tracemalloc

    import pyarrow as pa
    from pagemart.llm import lattice, nbsvm, simhash
    sent = {}

    class Frame:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):      # noqa: N802  as Spark names it
            sent["run"] = run

    def peak(call):
        tracemalloc.start()
        try:
            got = call()
            return got, tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()
    texts = [f"a{i}b  c{i},d  " * 1000 for i in range(1000)]       # 15 MB or more
    simhash.fingerprints(Frame(), "doc_id", "text", 4)
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(texts, pa.binary())], names=["doc_id", "t"])
    got, mb = peak(lambda: list(sent["run"](iter([batch]))))
    assert mb < 5 and got[0].column(1).to_numpy().view(np.uint64).tolist() == [simhash.simhash64(t.encode()) for t in texts]
    # distinct tokens: what is remembered of them is bounded
    features = nbsvm.Features()
    _, mb = peak(lambda: [features(" ".join(f"t{i * 1000 + j}" for j in range(1000))) for i in range(350)])
    assert mb < 30
    # a block of texts that have to be looked through word by word
    some = pa.array(texts[:200])
    (codes, lengths, words), mb = peak(lambda: lattice._numbered(some))
    found = [lattice.words_of(t) for t in texts[:200]]
    assert lengths.tolist() == [len(f) for f in found] and words.take(pa.array(codes)).to_pylist() == [w for f in found for w in f]
    assert mb < 25


def _nodes(plan, name):
    below = plan.children()
    own = [plan] if plan.getClass().getSimpleName() == name else []
    return own + [x for i in range(below.size()) for x in _nodes(below.apply(i), name)]


def test_texts_cross_to_python_once_and_pieces_need_no_python(spark, docs_of):
    from pagemart.llm import lattice, nbsvm
    docs = docs_of([(i, f"text {i}") for i in range(8)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    node, = _nodes(nbsvm.classify(docs, labels)._jdf.queryExecution().analyzed(), "MapInArrow")
    sent = node.child().output()
    assert [sent.apply(i).name() for i in range(sent.size())] == docs.columns
    pieces, byte0, _ = lattice.piece_table()
    words = spark.range(1).selectExpr("cast(id as int) AS bucket", "' word' AS word")
    encoded = lattice.encode_words(words, pieces, byte0)
    for node in _nodes(encoded._jdf.queryExecution().analyzed(), "LogicalRDD"):
        assert "PythonRDD" not in node.rdd().toDebugString()
    assert encoded.count() == 1
