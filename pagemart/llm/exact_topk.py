"""Exact top-k search by inner product over integer vectors: branch and bound on columns.

Candidates are kept in vertical layout, one array per dimension. A query adds up its scores one block of dimensions
after the other, the blocks in which it has most mass first. What the blocks not yet read can still add is bounded by the
product of what is left of the two vectors' lengths (Cauchy-Schwarz). A candidate whose bound is below the k-th best score
known so far leaves, and the survivors are compacted before the next block is read.

The work is cut into tiles, a bounded chunk of queries against a bounded slab of candidates. A tile is one stretch of
a sorted partition: its queries come first and are held, the candidates stream past, and at its end the tile's k best of
every query go out. Best ones of all slabs are merged per query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .vector_codes import EXACT, LONG_MAX, rows_of, scaled, usable

SCALE, TOP = 256, 5
DIM_BLOCK = 8                # dimensions added between two bounds
CHUNK_VALUES = 2 ** 21       # components of the queries of a tile (16 MB)
SLAB_ROWS = 2 ** 20          # candidates of a tile at most
LEAST_SLAB = 512             # and at least, where the table is small
BATCH = 4096                 # candidates in one vertical block
SLACK = 1 + 1e-9             # for the rounding of the two square roots


@dataclass
class Columns:
    """A block of candidates: ``cols[d]`` is dimension d, ``mass[b]`` the squared length of dimension block b."""
    ids: np.ndarray
    cols: np.ndarray
    mass: np.ndarray = field(init=False)
    whole: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        square = self.cols * self.cols
        self.mass = np.stack([square[a:a + DIM_BLOCK].sum(axis=0) for a in range(0, len(square), DIM_BLOCK)]) \
            if len(square) else np.zeros((0, self.cols.shape[1]), dtype=self.cols.dtype)
        self.whole = self.mass.sum(axis=0)


class Query:
    """A query vector with the k best candidates met so far."""

    def __init__(self, key: int, own: int | None, vec: np.ndarray, k: int):
        self.key, self.own, self.vec, self.k = key, own, vec, k
        mass = [int((vec[a:a + DIM_BLOCK] * vec[a:a + DIM_BLOCK]).sum()) for a in range(0, len(vec), DIM_BLOCK)]
        self.order = sorted(range(len(mass)), key=lambda b: -mass[b])
        self.rest = [sum(mass[b] for b in self.order[i + 1:]) for i in range(len(mass))]
        self.best: list[tuple[int, float]] = []      # heap of (score, minus id)
        self.read = 0                                # components read

    def worst(self) -> int | None:
        return self.best[0][0] if len(self.best) == self.k else None

    def meet(self, block: Columns) -> None:
        at = np.flatnonzero(block.ids != self.own) if self.own is not None else np.arange(len(block.ids))
        score = np.zeros(len(at), dtype=block.cols.dtype)
        left = block.whole[at]
        for i, b in enumerate(self.order):
            if not len(at):
                return
            rows = slice(b * DIM_BLOCK, (b + 1) * DIM_BLOCK)
            score = score + self.vec[rows] @ block.cols[rows][:, at]
            left = left - block.mass[b][at]
            self.read += len(at) * len(self.vec[rows])
            more = np.sqrt(left.astype(float)) * (math.sqrt(self.rest[i]) * SLACK)
            floor = self.worst()
            if len(at) > self.k:                     # k candidates that reach this whatever the rest is
                sure = score - more
                reached = np.partition(sure, len(at) - self.k)[len(at) - self.k]
                reached = min(math.floor(reached - abs(reached) * 1e-9) - 1, LONG_MAX)
                floor = reached if floor is None else max(floor, reached)
            if floor is not None:
                stay = score + more + abs(score.astype(float)) * 1e-9 + 1 >= floor
                at, score, left = at[stay], score[stay], left[stay]
        self.take(block.ids[at], score)

    def take(self, ids: np.ndarray, score: np.ndarray) -> None:
        if score.dtype == object:
            score = np.array([max(min(s, LONG_MAX), -LONG_MAX - 1) for s in score], dtype=object)
        if len(ids) > self.k:
            order = np.lexsort((ids, -score)) if score.dtype != object else sorted(range(len(ids)), key=lambda j: (-score[j], ids[j]))
            ids, score = ids[order[:self.k]], score[order[:self.k]]
        for i, s in zip(ids.tolist(), score.tolist()):
            entry = (s, -i)
            if len(self.best) < self.k:
                heapq.heappush(self.best, entry)
            elif entry > self.best[0]:
                heapq.heapreplace(self.best, entry)


class Tile:
    """Queries of a tile, which meet the tile's candidates block by block."""

    def __init__(self, width: int, k: int):
        self.width, self.k, self.queries, self.size = width, k, [], 0

    def add_queries(self, keys: list[int], ids: list, vecs: np.ndarray) -> None:
        self.size = max(self.size, int(abs(vecs).max()) if vecs.size else 0)
        self.queries += [Query(key, i, v, self.k) for key, i, v in zip(keys, ids, vecs)]

    def add_candidates(self, ids: np.ndarray, vecs: np.ndarray) -> None:
        size = max(self.size, int(abs(vecs).max()) if vecs.size else 0)
        for at in range(0, len(vecs), BATCH):
            cols = np.ascontiguousarray(vecs[at:at + BATCH].T)
            wide = self.width * size * size >= EXACT
            block = Columns(ids[at:at + BATCH], cols.astype(object) if wide else cols)
            for q in self.queries:
                if wide:
                    q.vec = q.vec.astype(object)
                q.meet(block)

    def found(self) -> list[tuple[int, int | None, int, int]]:
        return [(q.key, q.own, -i, s) for q in self.queries for s, i in q.best]


NO_ID = 2 ** 63 - 1      # stands for a null id: the last of equal scores
FOUND = "q_key long, query_id long, vec_id long, score long"


def _search_tiles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Walks tiles (width, chunk, slab) in sorted order; queries (key not null) come before candidates."""
    now, tile = None, None

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)],
                                          names=["q_key", "query_id", "vec_id", "score"])
    for batch in batches:
        tiles = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("width", "chunk", "slab", "role")], axis=1)
        cuts = [0, *(np.flatnonzero((tiles[1:] != tiles[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            *here, role = tiles[a].tolist()
            if here != now:
                if tile is not None:
                    yield out(tile.found())
                now, tile = here, Tile(here[0], k)
            part = batch.slice(a, b - a)
            vecs = rows_of(part.column("vec"), here[0])
            if role == 0:
                tile.add_queries(part.column("key").to_pylist(), part.column("id").to_pylist(), vecs)
            else:
                tile.add_candidates(part.column("id").to_numpy(zero_copy_only=False).astype(np.int64), vecs)
    if tile is not None:
        yield out(tile.found())


def search(vectors: DataFrame, is_query: Column, k: int = TOP, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """The ``k`` candidates of highest integer inner product for every query: rows (query_id, rank, vec_id, score), ties to
    the smaller id; all candidates, if there are fewer.

    Components become floor(256 * x). Candidates are all rows with another id than the query's; a null id counts as
    another id than any, is last among ties and comes back as null. A row with a null id can only be a query if ``is_query`` says
    so. Queries that repeat id and vector are one; queries that share an id only are searched each. Repeated candidates are rows of their own.
    Null vectors and vectors with null or non-finite components take no part, zero vectors do. Vectors of different length have no
    inner product and are not compared. Components and scores beyond the range of a long stay at its bounds, and tie there. An
    empty table gives no rows; further columns play no part, whatever their names."""
    spark = vectors.sparkSession
    rows = settle(vectors.where(usable(vec)).select(
        F.col(vec_id).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), scaled(vec, SCALE).alias("vec"),
        F.monotonically_increasing_id().alias("at")), "topk-ints").withColumn("width", F.size("vec"))
    queries = settle(rows.where("asks").select("width", "id", "vec").dropDuplicates().withColumn("key", F.monotonically_increasing_id()),
                     "topk-queries")
    # one row per vector length: how many chunks and slabs its tiles make
    tasks = 4 * spark.sparkContext.defaultParallelism
    per_chunk = F.greatest(F.lit(CHUNK_VALUES).cast("double") / F.greatest("width", F.lit(1)), F.lit(1.0))
    cuts = (rows.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("m"))
            .select("width", F.ceil(F.col("m") / per_chunk).cast("int").alias("chunks"),
                    F.greatest(F.ceil(F.col("n") / SLAB_ROWS), F.least(F.lit(tasks), F.ceil(F.col("n") / LEAST_SLAB))).cast("int").alias("slabs"))
            .where("chunks > 0").collect())        # at most one row per length
    empty = "query_id long, rank int, vec_id long, score long"
    if not cuts:
        return spark.createDataFrame([], empty)
    by_width = F.create_map(*[F.lit(x) for c in cuts for x in (c.width, 0)])
    chunks, slabs = (F.create_map(*[F.lit(x) for c in cuts for x in (c.width, c[i])])[F.col("width")] for i in (1, 2))
    asked = rows.where(by_width[F.col("width")].isNotNull())

    def dealt(n: Column, *by: str) -> Column:
        return F.pmod(F.xxhash64(*by), n).cast("int")
    left = queries.select("width", "id", "vec", "key", dealt(chunks, "key").alias("chunk"),
                          F.explode(F.sequence(F.lit(0), slabs - 1)).alias("slab"), F.lit(0).alias("role"))
    right = asked.select("width", F.coalesce("id", F.lit(NO_ID)).alias("id"), "vec", F.lit(None).cast("long").alias("key"),
                         F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), dealt(slabs, "at").alias("slab"), F.lit(1).alias("role"))
    tile = ["width", "chunk", "slab"]
    n_tiles = sum(c.chunks * c.slabs for c in cuts)
    tiles = left.unionByName(right).repartition(n_tiles, *tile).sortWithinPartitions(*tile, "role")
    found = tiles.mapInArrow(lambda batches: _search_tiles(batches, k), FOUND)
    rank = F.row_number().over(Window.partitionBy("q_key").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score"))


# Every query against every row, in doubles (exact below 2^53); for tables whose vectors have one length.
TOPK_SQL = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM kept q JOIN kept c ON q.vec_id IS DISTINCT FROM c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= {TOP}
"""
