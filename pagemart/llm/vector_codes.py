"""Vector codes: integer vectors cut into parts, each part replaced by the index of its nearest codebook entry.

Codebooks are fitted by rounds of assignment and floored means over all rows. All arithmetic is on integers, so a
result does not depend on how rows are dealt to tasks.

The nearest entry is found through a grid. A part's coarse cell (its components divided by the cell width, rounded down) is
a box; for a box the least and largest distance to every entry are known from its corners. An entry whose least
distance is above another's largest distance is nearest to no point of the box. Each task remembers, per
cell it has met, which entries are left, and only these are compared exactly with the parts that fall in the cell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, settle

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
SLICE = 512               # parts handled at once
MAX_CELLS = 65_536        # cells a task remembers per part; then it forgets them and goes on
CELLS_PER_SPREAD = 4      # a cell is about a quarter of the entries' standard deviation wide
EXACT = 2 ** 62           # above this, numpy's 64-bit integers give way to Python's
LONG_MAX = 2 ** 63 - 1


def usable(vec: str) -> Column:
    """Neither null nor holding a null or non-finite component."""
    return F.expr(f"`{vec}` IS NOT NULL AND forall(`{vec}`, x -> x IS NOT NULL AND x > double('-Infinity') AND x < double('Infinity'))")


def scaled(vec: str, scale: int) -> Column:
    """Components as integers floor(scale * x), held at the bounds of a long."""
    return F.expr(f"transform(`{vec}`, x -> floor({scale}D * double(x)))")


def rows_of(column: pa.Array, width: int) -> np.ndarray:
    """A list column of ``width`` values a row as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


@dataclass
class Codebook:
    """Entries of one part position, with the cells met so far. ``met`` and ``compared`` count cells and exact comparisons."""
    entries: np.ndarray
    width: int = 1
    known: dict[bytes, np.ndarray] = field(default_factory=dict)
    met: int = 0
    compared: int = 0

    def __post_init__(self) -> None:
        spread = float(np.std(self.entries.astype(float))) if self.entries.size else 0.0
        self.width = 2 ** max(0, int(np.log2(max(spread / CELLS_PER_SPREAD, 1))))

    def left(self, cells: np.ndarray) -> np.ndarray:
        """Per cell, which entries are not dominated across its box."""
        low = cells[:, None, :] * self.width
        high = low + (self.width - 1)
        e = self.entries[None]
        least = _squares(np.maximum(np.maximum(low - e, e - high), 0))
        largest = _squares(np.maximum(abs(e - low), abs(high - e)))
        return least <= largest.min(axis=1)[:, None]

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """Entries left for every part, from the cells' memory."""
        cells = parts // self.width
        keys = [c.tobytes() for c in cells] if cells.dtype != object else [repr(c.tolist()).encode() for c in cells]
        if len(self.known) > MAX_CELLS:
            self.known.clear()
        new = {k: i for i, k in enumerate(keys) if k not in self.known}
        if new:
            self.met += len(new)
            for k, mask in zip(new, self.left(cells[list(new.values())])):
                self.known[k] = np.packbits(mask)
        return np.unpackbits(np.stack([self.known[k] for k in keys]), axis=1, count=len(self.entries)).astype(bool)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lower) and its squared distance."""
        size = max((int(abs(a).max()) for a in (parts, self.entries) if a.size), default=0)
        if parts.shape[1] * (2 * size + 2 * self.width) ** 2 >= EXACT:
            if self.entries.dtype != object:
                self.entries, self.known = self.entries.astype(object), {}
            parts = parts.astype(object)
        row, entry = np.nonzero(self.candidates(parts))
        self.compared += len(row)
        distance = _squares(parts[row] - self.entries[entry])
        start = np.searchsorted(row, np.arange(len(parts)))
        best = np.minimum.reduceat(distance, start)
        hit = np.flatnonzero(distance == best[row])
        first = hit[np.searchsorted(row[hit], np.arange(len(parts)))]
        return entry[first], best


def bounds(width: int) -> list[tuple[int, int]]:
    cut = [width * p // PARTS for p in range(PARTS + 1)]
    return list(zip(cut, cut[1:]))


def _encoded(books: list[np.ndarray], width: int) -> Callable[[pa.Array], Iterator[tuple[slice, list, list]]]:
    """A function of an integer list column that yields, slice by slice, the codes and distances by part. Its memory of
    cells lasts as long as the task."""
    own = [Codebook(b) for b in books]

    def run(column: pa.Array) -> Iterator[tuple[slice, list, list]]:
        x = rows_of(column, width)
        for at in range(0, len(x), SLICE):
            here = x[at:at + SLICE]
            found = [book.nearest(here[:, a:b]) for book, (a, b) in zip(own, bounds(width))]
            yield slice(at, at + len(here)), [f[0] for f in found], [f[1] for f in found]
    return run


def _means(rows: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Every entry replaced by the floored mean of its parts. A task reports one row per entry, the driver at most
    ENTRIES * width sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoded(books, width)
        n = [np.zeros(len(b), dtype=np.int64) for b in books]
        total = [np.zeros(b.shape, dtype=object) for b in books]
        for batch in batches:
            x = rows_of(batch.column("ints"), width)
            for at, codes, _ in encode(batch.column("ints")):
                for p, (a, b) in enumerate(bounds(width)):
                    part = x[at, a:b]
                    if part.size and int(abs(part).max()) >= 2 ** 48:
                        part = part.astype(object)
                    added = np.zeros(books[p].shape, dtype=part.dtype)
                    np.add.at(added, codes[p], part)
                    n[p] += np.bincount(codes[p], minlength=len(n[p]))
                    total[p] += added.astype(object)
        used = [(p, e) for p in range(PARTS) for e in np.flatnonzero(n[p])]
        yield pa.RecordBatch.from_arrays([
            pa.array([p for p, _ in used], pa.int32()), pa.array([int(e) for _, e in used], pa.int32()),
            pa.array([int(n[p][e]) for p, e in used], pa.int64()),
            pa.array([[Decimal(int(s)) for s in total[p][e]] for p, e in used], pa.list_(pa.decimal128(38, 0)))],
            names=["part", "entry", "n", "sums"])
    partial = rows.select("ints").mapInArrow(run, "part int, entry int, n long, sums array<decimal(38,0)>")
    sums = (partial.select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
            .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    fitted = [b.copy() for b in books]
    for r in sums:
        fitted[r.part][r.entry, r.at] = int(r.s) // int(r.n)
    return fitted


def _fit(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Codebooks of vectors that all have ``width`` components."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(ENTRIES).select("ints").collect()
    start = np.array([r.ints for r in first], dtype=np.int64).reshape(len(first), width)
    books = [start[:, a:b].copy() for a, b in bounds(width)]
    for _ in range(ROUNDS):
        books = _means(rows, books, width)
    return books


def _codes(rows: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoded(books, width)
        for batch in batches:
            for at, codes, distances in encode(batch.column("ints")):
                own = batch.slice(at.start, at.stop - at.start)
                error = [min(int(sum(d)), LONG_MAX) for d in zip(*(x.tolist() for x in distances))]
                code = [bytes(c).hex() for c in zip(*(x.tolist() for x in codes))]
                yield pa.RecordBatch.from_arrays([own.column("vec_id"), own.column("label"), pa.array(code), pa.array(error, pa.int64())],
                                                 names=["vec_id", "label", "code", "error"])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    coded = rows.select("vec_id", "label", "ints").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    return coded.withColumn("codebooks_sha256", F.lit(codebooks_hash(books)))


def codebooks_hash(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.reshape(-1)).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> tuple[DataFrame, dict[int, list[np.ndarray]]]:
    """One row per usable row of ``vectors``: vec_id, label, code (two hex digits per part), error (squared distance of the
    integer vector to its entries), label_error (error summed over rows of the same label, null being one) and codebooks_sha256;
    and the codebooks, a matrix per part, by vector length.

    Components become floor(1024 * x). Codebooks start from the 256 smallest ids (null ids last, rows that share an
    id by their components; fewer rows: fewer entries). Null vectors and vectors with null or non-finite components
    take no part; zero and empty vectors do. Vectors of another length have codebooks of their own, fitted one length after
    the other; a length that four does not divide gives parts that differ by one component. Repeated rows are coded each,
    and weigh in the means. Components beyond the range of a long stay at its bounds, as do errors. An empty table gives no rows;
    further columns play no part, whatever their names."""
    ints = settle(vectors.where(usable(vec)).select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                                                    scaled(vec, SCALE).alias("ints")), "codes-ints")
    widths = {r.w: r.n for r in ints.groupBy(F.size("ints").alias("w")).agg(F.count(F.lit(1)).alias("n")).collect()}
    books: dict[int, list[np.ndarray]] = {}
    coded = ints.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256")).limit(0)
    for w in sorted(widths):
        own = ints.where(F.size("ints") == w)
        books[w] = _fit(own, w)
        coded = coded.unionByName(_codes(own, books[w], w))
    coded = settle(coded.withColumn("k", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))), "codes")
    errors = coded.groupBy("k").agg(F.count(F.lit(1)).alias("k_n"), F.sum(F.col("error").cast("decimal(38,0)")).alias("s"))
    errors = errors.select("k", "k_n", F.least("s", F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return lookup(coded, errors, ["k"], "k_n", sum(widths.values())).select(
        F.col("vec_id").alias(vec_id), F.col("label").alias(label), "code", "error", "label_error", "codebooks_sha256"), books


def _sql_round(r: int) -> str:
    return f"""
, near{r} AS MATERIALIZED (
  SELECT p.row, p.p, min(struct_pack(d := p.s - 2 * list_inner_product(p.q, b.c) + b.s, e := b.e)) AS m
  FROM parts p JOIN book{r} b ON b.p = p.p GROUP BY p.row, p.p
), sums{r} AS (
  SELECT n.p, n.m.e AS e, i, sum(CAST(p.q[i] AS HUGEINT)) AS s, CAST(count(*) AS HUGEINT) AS n
  FROM near{r} n JOIN parts p ON p.row = n.row AND p.p = n.p, LATERAL (SELECT unnest(range(1, len(p.q) + 1)) AS i) GROUP BY ALL
), book{r + 1} AS MATERIALIZED (
  SELECT *, list_inner_product(c, c) AS s FROM (
    SELECT b.p, b.e, coalesce(f.c, b.c) AS c FROM book{r} b LEFT JOIN (
      SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS c FROM sums{r} GROUP BY p, e) f ON f.p = b.p AND f.e = b.e)
)"""


# All parts against all entries, in doubles (exact below 2^53); for tables whose vectors have one length.
CODES_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS row, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT *, list_inner_product(q, q) AS s FROM (
    SELECT row, p, v[len(v) * p // {PARTS} + 1 : len(v) * (p + 1) // {PARTS}] AS q FROM kept, (SELECT unnest(range({PARTS})) AS p))
), book0 AS MATERIALIZED (SELECT p, row - 1 AS e, q AS c, s FROM parts WHERE row <= {ENTRIES})
{''.join(_sql_round(r) for r in range(ROUNDS + 1))}
, coded AS (
  SELECT row, string_agg(printf('%02x', CAST(m.e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY row
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e))
        FROM book{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (row)
"""
