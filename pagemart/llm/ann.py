"""Approximate nearest neighbours over balanced posting lists.

Centroids come from a two-level k-means on a bounded sample, with more sub-centroids for larger clusters,
so that the posting lists are about even. A proximity graph over the centroids is searched in memory, by a beam. Every vector
enters the list of its nearest centroid and, if it lies near a boundary, those of further centroids within a distance
ratio. A query finds its lists by the graph as well: those within a ratio of the nearest, out of a budget of nearest lists.
Ratio and budget are set by the recall of a bounded sample of queries on the sample of vectors, so they grow with what the data need. Lists are
dealt out to shards, a bounded number of vectors each; a query goes to a shard once, reads its lists there, and its best
of the whole shard come back. Equal vectors are one row of the index; their ids are kept beside it. Vectors of different
length have indexes of their own.

Distances that pick candidates are taken from vectors moved to the sample's middle and allow for their rounding; results
are distances of the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, map_batches, settle

LIST_ROWS = 200          # vectors per list aimed at
MAX_LISTS = 16_384
SAMPLE_PER_LIST = 8      # the sample has at most MAX_LISTS * SAMPLE_PER_LIST vectors
REPLICA_RATIO, REPLICAS = 1.12, 4
SEARCH_RATIO = 1.35      # at least
PROBES, PROBE_RECALL = 256, 0.99     # sample queries, and the share of their sample neighbours that the budget of lists has to reach
SHARD_ROWS = 65_536      # postings of a shard
CHUNK_ROWS = 4096        # queries that meet a shard at once
SLICE_ROWS = 8192        # rows of a batch handed on
DEGREE, BEAM = 16, 64


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of c."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :], 0)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    near = np.zeros(len(x), dtype=np.int64)
    for _ in range(rounds):
        near = _distances(x, c).argmin(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c, near


def balanced_centroids(sample: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """About ``k`` centroids: coarse clusters get sub-centroids in proportion to their size."""
    rng = np.random.default_rng(seed)
    _, near = _kmeans(sample, max(1, round(k ** 0.5)), rng)
    parts = []
    for g in np.unique(near):
        own = sample[near == g]
        parts.append(_kmeans(own, max(1, round(k * len(own) / len(sample))), rng)[0])
    return np.unique(np.concatenate(parts), axis=0)


@dataclass
class CentroidGraph:
    """Nearest-neighbour graph over the centroids, entered at fixed, spread nodes."""
    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray

    @staticmethod
    def build(centroids: np.ndarray, degree: int = DEGREE) -> "CentroidGraph":
        k = len(centroids)
        rows = [np.argsort(_distances(centroids[i:i + 512], centroids), axis=1, kind="stable")[:, :degree + 1]
                for i in range(0, k, 512)]
        near = np.concatenate(rows)
        # links both ways: a small cluster apart from the others is reached through those it is nearest to
        source, target = np.repeat(np.arange(k), near.shape[1]), near.ravel()
        order = np.lexsort((np.tile(np.arange(near.shape[1]), k), target))
        place = np.arange(len(order)) - np.searchsorted(target[order], target[order])
        back = np.tile(np.arange(k)[:, None], (1, degree))
        some = place < degree
        back[target[order][some], place[some]] = source[order][some]
        return CentroidGraph(centroids, np.concatenate([near, back], axis=1), np.arange(0, k, max(1, k // max(256, 4 * round(k ** 0.5)))))

    def search(self, x: np.ndarray, n: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` nearest centroids found for every row of x, and their distances: best-first search with a beam,
        for all rows at once."""
        k, m = len(self.centroids), len(x)
        beam = min(max(beam, n), k)
        norm = (self.centroids ** 2).sum(1)
        own = (x * x).sum(1)
        start = _distances(x, self.centroids[self.entries])
        dist, nodes = np.full((m, beam), np.inf), np.full((m, beam), -1)
        take = min(beam, len(self.entries))
        first = np.argpartition(start, take - 1, axis=1)[:, :take]
        dist[:, :take], nodes[:, :take] = np.take_along_axis(start, first, 1), self.entries[first]
        done = nodes < 0
        rows = np.arange(m)
        for _ in range(beam):
            open_ = np.where(done, np.inf, dist)
            best = open_.argmin(1)
            live = np.flatnonzero(np.isfinite(open_[rows, best]))
            if not len(live):
                break
            done[live, best[live]] = True
            new = self.neighbours[nodes[live, best[live]]]
            d = np.maximum(own[live][:, None] + norm[new] - 2 * np.einsum("nd,nkd->nk", x[live], self.centroids[new]), 0)
            d[(new[:, :, None] == nodes[live][:, None, :]).any(2)] = np.inf       # already in the beam
            near_order = np.argsort(new, axis=1, kind="stable")                      # a node may be linked twice
            twice = np.zeros_like(d, dtype=bool)
            np.put_along_axis(twice, near_order[:, 1:], np.diff(np.take_along_axis(new, near_order, 1), axis=1) == 0, axis=1)
            d[twice] = np.inf
            all_d, all_n = np.concatenate([dist[live], d], 1), np.concatenate([nodes[live], new], 1)
            all_done = np.concatenate([done[live], np.isinf(d)], 1)
            keep = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            dist[live], nodes[live] = np.take_along_axis(all_d, keep, 1), np.take_along_axis(all_n, keep, 1)
            done[live] = np.take_along_axis(all_done, keep, 1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :n]
        return np.take_along_axis(nodes, order, 1), np.sqrt(np.take_along_axis(dist, order, 1))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors from their bytes (little-endian doubles)."""
    return np.stack([np.frombuffer(v, dtype="<f8") for v in column.to_pylist()])


def clean_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vec): usable vectors as bytes of doubles. Null, empty, zero ones and those with null or non-finite
    components are left out, as are rows without an id."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, out = [], []
        for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if i is None or not v or any(c is None for c in v):
                continue
            a = np.asarray(v, dtype="<f8") + 0.0
            if np.isfinite(a).all() and a.any():
                ids.append(i)
                out.append(a.tobytes())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "vec"])
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    return map_batches(rows, run, "vec_id long, vec binary")


def search_bounds(sample: np.ndarray, graph: CentroidGraph, k: int = 10) -> tuple[int, float]:
    """How many nearest lists, and which distance ratio, reach ``PROBE_RECALL`` of the ``k`` nearest sample vectors of ``PROBES`` of
    them, each vector standing in the lists that ``assign_lists`` gives it."""
    lists = len(graph.centroids)
    probes = sample[:PROBES]
    if len(sample) <= k + 1 or lists == 1:
        return lists, math.inf
    to_lists = np.sqrt(_distances(probes, graph.centroids))
    place = np.empty((len(probes), lists), dtype=np.int64)                   # place[q, l]: how near list l is to probe q
    np.put_along_axis(place, np.argsort(to_lists, axis=1, kind="stable"), np.arange(lists)[None, :], axis=1)
    near = np.argsort(_distances(probes, sample), axis=1, kind="stable")[:, :k + 1]
    members = np.unique(near)
    at, dist = graph.search(sample[members], min(REPLICAS, lists))
    held = np.where((at >= 0) & (dist <= REPLICA_RATIO * dist.min(1, keepdims=True) + 1e-12), at, at[:, :1])
    own = held[np.searchsorted(members, near)].reshape(len(probes), -1)      # (probe, neighbour and its lists)
    shape = (*near.shape, -1)
    rank = np.take_along_axis(place, own, axis=1).reshape(shape).min(2)
    ratio = (np.take_along_axis(to_lists, own, axis=1).reshape(shape).min(2) + 1e-12) / (to_lists.min(1) + 1e-12)[:, None]
    half = 1 - (1 - PROBE_RECALL) / 2                                        # each of the two bounds may lose half
    return int(np.quantile(rank, half)) + 1, max(SEARCH_RATIO, float(np.quantile(ratio, half)))


def assign_lists(classes: DataFrame, graph, ratio: float, most: int) -> DataFrame:
    """``classes`` (cid, vec), one row each with lists: those of the ``most`` nearest lists the graph finds whose centroid is within
    ``ratio`` of the nearest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, *parts = graph.value
        index = CentroidGraph(*parts)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                lists, dist = index.search(_matrix(part.column(1)) - centre, most, max(BEAM, most))
                fits = (lists >= 0) & (dist <= ratio * dist.min(1, keepdims=True) + 1e-12)
                fits[:, 0] = True
                found = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(fits.sum(1))]), pa.int32()), pa.array(lists[fits], pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), found], names=["cid", "vec", "lists"])
    return classes.select("cid", "vec").mapInArrow(run, "cid long, vec binary, lists array<int>")


def _nearest(top: int):
    """Cogrouped queries and postings of one shard: every query's ``top`` nearest among the postings of its lists."""
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out_q, out_c, out_s = [], [], []
        if queries.num_rows and rows.num_rows:
            p, ids, own = _matrix(rows["vec"].combine_chunks()), rows["cid"].to_numpy(), rows["list"].to_numpy()
            order = np.argsort(own, kind="stable")
            p, ids, own = p[order], ids[order], own[order]
            heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            spans = dict(zip(own[heads].tolist(), zip(heads.tolist(), [*heads[1:].tolist(), len(own)], strict=True), strict=True))
            moved = p - p.mean(0)
            size = (moved * moved).sum(1)
            asked = queries["lists"].combine_chunks()
            for i, (q_id, q) in enumerate(zip(queries["cid"].to_pylist(), _matrix(queries["vec"].combine_chunks()), strict=True)):
                at = np.concatenate([np.arange(*spans[x]) for x in asked[i].values.to_pylist() if x in spans] or [np.zeros(0, dtype=int)])
                if not len(at):
                    continue
                m = q - p.mean(0)
                rough = size[at] - 2 * (moved[at] @ m)
                few = top * REPLICAS                                         # a vector may stand in so many lists
                if len(at) > few:
                    # what rounding may hide is looked at as well
                    slack = 1e-12 * (size[at].max() + m @ m) * (8 + len(m))
                    at = at[rough <= np.partition(rough, few - 1)[few - 1] + slack]
                at = at[np.unique(ids[at], return_index=True)[1]]
                exact = np.sqrt(((q - p[at]) ** 2).sum(1))
                best = np.lexsort((ids[at], exact))[:top]
                out_q.append(np.full(len(best), q_id))
                out_c.append(ids[at][best])
                out_s.append(exact[best])
        cat = lambda x, t: pa.array(np.concatenate(x) if x else [], t)
        return pa.table({"q": cat(out_q, pa.int64()), "cid": cat(out_c, pa.int64()), "score": cat(out_s, pa.float64())})
    return run


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found of every row for which ``is_query`` (a condition on vec_id) holds: query_id, rank (from 1),
    vec_id, score (Euclidean distance of the original vectors, in double precision); ties go to the smaller vec_id. The
    query's own row is no candidate.

    Vectors that ``clean_vectors`` leaves out take no part. Vectors of different length are no candidates of each other. Repeated rows
    (same id and vector) count once. Fewer candidates than ``k`` give fewer rows; an empty table none. Further columns play no part."""
    spark = vectors.sparkSession
    rows = settle(clean_vectors(vectors, vec_id, embedding).distinct(), "ann-rows")
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # one search per vector length; a table of embeddings has one
    for r in sorted(rows.groupBy(F.length("vec").alias("size")).agg(F.max(is_query.cast("int")).alias("asked")).collect()):
        if r["asked"]:
            found = found.unionByName(_search(rows.where(F.length("vec") == r["size"]), is_query, k))
    return found


def _search(rows: DataFrame, is_query, k: int) -> DataFrame:
    """``nearest_neighbours`` of (vec_id, vec) rows of one length, none repeated."""
    spark = rows.sparkSession
    # equal vectors are one class: its smallest ids are all a result can need of it
    sizes = rows.groupBy("vec").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("n"),
                                    F.max(is_query.cast("int")).alias("asked"))
    classes = settle(sizes, "ann-classes")
    order = Window.partitionBy("vec").orderBy("vec_id")
    ids = (rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
           .groupBy("vec").agg(F.min("vec_id").alias("cid"), F.sort_array(F.collect_list("vec_id")).alias("ids")).drop("vec"))
    total = classes.count()      # distinct vectors: what the lists hold

    lists = int(min(MAX_LISTS, max(1, total // LIST_ROWS)))
    sample = (classes.select("vec").orderBy(F.xxhash64("vec")).limit(SAMPLE_PER_LIST * MAX_LISTS if lists == MAX_LISTS
                                                                     else max(1000, SAMPLE_PER_LIST * lists)).toArrow())
    drawn = _matrix(sample["vec"].combine_chunks())
    centre = drawn.mean(0)
    built = CentroidGraph.build(balanced_centroids(drawn - centre, lists))
    budget, ratio = search_bounds(drawn - centre, built, k)
    graph = spark.sparkContext.broadcast((centre, built.centroids, built.neighbours, built.entries))

    postings = settle(assign_lists(classes, graph, REPLICA_RATIO, REPLICAS).select("cid", "vec", F.explode("lists").alias("list")), "ann-postings")
    asked = settle(assign_lists(classes.where("asked = 1"), graph, ratio, budget), "ann-asked")
    # a list's postings lie in one shard or, if it is long, in several of its own; one row per list (at most MAX_LISTS and a few)
    counts = postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("list").rowsBetween(Window.unboundedPreceding, -1))
    shards = F.broadcast(settle(counts.select("list", F.floor(F.coalesce(before, F.lit(0)) / SHARD_ROWS).cast("int").alias("shard"),
                                              F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("parts")), "ann-shards"))
    n_chunks = max(1, -(-asked.count() // CHUNK_ROWS))
    own = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int").alias("part")
    right = (postings.join(shards, "list").select("shard", own, "list", "cid", "vec")
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk")))
    wanted = (asked.select("cid", F.explode("lists").alias("list")).join(shards, "list")
              .select("cid", "list", "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
              .groupBy("cid", "shard", "part").agg(F.collect_set("list").alias("lists")))
    left = (wanted.join(asked.select("cid", "vec"), "cid")
            .select("shard", "part", F.pmod(F.xxhash64("cid"), F.lit(n_chunks)).cast("int").alias("chunk"), "cid", "vec", "lists"))
    key = ["shard", "part", "chunk"]
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_nearest(k + 1), "q long, cid long, score double")

    best = found.groupBy("q", "cid").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "cid"))
    best = best.withColumn("r", rank).where(F.col("r") <= k + 1).join(ids, "cid")
    answers = best.groupBy("q").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    answers = settle(answers.join(classes.select(F.col("cid").alias("q"), "n"), "q").withColumnRenamed("q", "cid"), "ann-answers")

    queries = settle(rows.where(is_query).join(classes.select("vec", "cid"), "vec").select(F.col("vec_id").alias("query_id"), "cid"), "ann-queries")
    each = (lookup(queries, answers, ["cid"], "n", rows.count()).select("query_id", F.explode("found").alias("f"))
            .select("query_id", "f.score", F.explode("f.ids").alias("vec_id")).where("vec_id <> query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
