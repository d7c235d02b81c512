"""SimHash near-duplicates with pivot distance tables.

Every distinct fingerprint gets its Hamming distances to fixed reference fingerprints (pivots),
computed once. Two fingerprints that differ in at most ``max_bits`` bits have pivot distances that
differ by at most ``max_bits`` in every coordinate (triangle inequality), so a pair with a larger
coordinate difference is discarded without a look at it; the survivors are verified on all bits.

Which pairs are held against each other at all comes from equal bit blocks, not from all pairs:
the 64 bits are cut into ``max_bits + 3`` blocks, so at least three blocks of a link are equal and one
of the tables "these three blocks" has both in one bucket. Exact copies of a fingerprint are one
row. Buckets above a bound are dealt over block pairs of their members; each task reports only links that
join something new (a forest), never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_KEYS, components, doc_key, each_bytes, lookup, map_batches, settle

PIVOTS = 8            # one byte of a long each
BUCKET_ROWS = 4096    # members of a bucket that one task compares


def simhash64(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Fingerprint of a text: a bit is set if more than half of the shingle hashes have it.
    Words are runs of non-white-space bytes, A-Z lower-cased; a text of fewer than ``shingle`` words is
    one shingle; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(shingles), 65536):
        hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles[at:at + 65536]], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(shingles)).tobytes(), "big")


def pivots(n: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), 7) for i in range(n)], dtype=np.uint64)


def pivot_distances(fp: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to the pivots, as (n, PIVOTS) bytes."""
    return np.bitwise_count(fp.astype(np.uint64)[:, None] ^ pivots()[None, :]).astype(np.uint8)


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, fp): no shuffle, null texts count as empty."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([simhash64(t, shingle) for t in each_bytes(b.column(1))], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])
    return map_batches(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t")),
                       run, "doc_id long, fp long")


def _with_pivots(distinct: DataFrame) -> DataFrame:
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = b.column(0).to_numpy(zero_copy_only=False)
        packed = pivot_distances(fp.view(np.uint64)).reshape(-1).view(np.int64)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(packed)], names=["fp", "pd"])
    return map_batches(distinct.select("fp"), run, "fp long, pd long")


def block_masks(max_bits: int) -> list[int]:
    """Masks of the bucket tables, as signed longs: three of ``max_bits + 3`` blocks each."""
    n = max_bits + 3
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [a | b | c for a, b, c in combinations(blocks, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class _Forest:
    """Union-find over the fingerprints one task has linked; keeps only links that join."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (p := self.up.get(root, root)) != root:
            root = p
        while x != root:
            self.up[x], x = root, self.up.get(x, x)
        return root

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        if a == b:
            return False
        self.up[a] = b
        return True


def _verified_pairs(group: np.ndarray, fp: np.ndarray, pd: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of the same group (groups are contiguous) within ``max_bits`` bits."""
    at, lag = np.arange(len(fp)), 1
    while len(at):
        at = at[at < len(fp) - lag]
        at = at[group[at] == group[at + lag]]
        near = at[np.abs(pd[at] - pd[at + lag]).max(axis=1) <= max_bits] if len(at) else at
        near = near[np.bitwise_count(fp[near] ^ fp[near + lag]) <= max_bits]
        if len(near):
            yield near, near + lag
        lag += 1


def _links(masks: list[int], max_bits: int):
    mask = np.array(masks, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, kept = _Forest(), None

        def flush(rows: np.ndarray) -> pa.RecordBatch:
            t, fp, pd, salt = (np.ascontiguousarray(x) for x in rows)
            key = fp & mask[t]
            new = (np.diff(t) != 0) | (np.diff(key) != 0) | (np.diff(salt) != 0)
            group = np.concatenate([[0], np.cumsum(new)])
            coords = np.ascontiguousarray(pd).view(np.uint8).reshape(-1, PIVOTS).astype(np.int16)
            a, b = [], []
            for i, j in _verified_pairs(group, fp.view(np.uint64), coords, max_bits):
                for x, y in zip(fp[i].tolist(), fp[j].tolist(), strict=True):
                    if forest.join(x, y):
                        a.append(x)
                        b.append(y)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            rows = rows if kept is None else np.concatenate([kept, rows], axis=1)
            if not rows.shape[1]:
                continue
            t, fp, _, salt = rows
            key = fp & mask[t]
            same = (t == t[-1]) & (key == key[-1]) & (salt == salt[-1])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield flush(rows[:, :cut])
            kept = rows[:, cut:]
        if kept is not None and kept.shape[1]:
            yield flush(kept)
    return run


def fingerprint_links(distinct: DataFrame, max_bits: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """A forest (a, b) of the links between distinct fingerprints ``distinct(fp, pd)``."""
    masks = block_masks(max_bits)
    table = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).alias("m")) for i, m in enumerate(masks)]))
    rows = distinct.select("fp", "pd", table.alias("x")).select("x.t", F.col("fp").bitwiseAND(F.col("x.m")).alias("key"), "fp", "pd")
    total = distinct.count() * len(masks)
    hot = (rows.groupBy("t", "key").count().where(F.col("count") > max(bucket_rows, total // HOT_KEYS))
           .select("t", "key", F.ceil(F.col("count") / bucket_rows).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.least(o, part) * F.col("parts") + F.greatest(o, part)))
    dealt = rows.join(F.broadcast(hot), ["t", "key"], "left").select("t", "key", "fp", "pd", F.explode(pairs).alias("salt"))
    # the key is fp & mask of the table, so the shuffle need not carry it
    order = ["t", "key", "salt"]
    dealt = dealt.repartition(*order).sortWithinPartitions(*order, "fp").select("t", "fp", "pd", "salt")
    return dealt.mapInArrow(_links(masks, max_bits), "a long, b long")


def _roots(classes: DataFrame, max_bits: int) -> DataFrame:
    """(node, root) of the distinct fingerprints ``classes(fp)`` that have a link."""
    distinct = settle(_with_pivots(classes), "simhash-pivots")
    return components(fingerprint_links(distinct, max_bits), "simhash-links")


def group_firsts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per group of near-duplicates, groups without an id included: the key (k_id, k_text) of its first row by
    (doc_id, text hash), rows without an id last. Groups are those of ``near_duplicates``; equal fingerprints meet by a
    partial aggregation."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([simhash64(t, shingle) for t in each_bytes(b.column(3))], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(fp)], names=["nameless", "k_id", "k_text", "fp"])
    keyed = docs.select(F.col(doc_id).isNull().alias("nameless"), *doc_key(doc_id, text), F.col(text).cast("binary").alias("t"))
    rows = map_batches(keyed, run, "nameless boolean, k_id long, k_text long, fp long")
    classes = settle(rows.groupBy("fp").agg(F.min(F.struct("nameless", "k_id", "k_text")).alias("first")), "simhash-firsts")
    grouped = classes.join(_roots(classes, max_bits).toDF("fp", "root"), "fp", "left").select(F.coalesce("root", "fp").alias("root"), "first")
    return grouped.groupBy("root").agg(F.min("first").alias("first")).select("first.k_id", "first.k_text")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                    max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Documents are linked when their fingerprints differ in at most ``max_bits`` bits;
    ``component_id`` is the smallest doc_id reachable. Null, empty and blank texts have fingerprint
    zero and link like any other. A row with a null id takes part and gets its group's id (null when
    no member has one). Repeated rows are returned each. Other columns of ``docs`` are not read."""
    fps = settle(fingerprints(docs, doc_id, text, shingle), "simhash-fp")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    classes = settle(classes, "simhash-classes")
    roots = _roots(classes, max_bits)
    linked = classes.join(roots.toDF("fp", "root"), "fp")
    least = linked.groupBy("root").agg(F.min("first_id").alias("least"))
    merged = linked.join(least, "root").select("fp", "least")
    labels = (classes.join(merged, "fp", "left")
              .select("fp", "n", F.coalesce("least", "first_id").alias("component_id")))
    labels = settle(labels, "simhash-labels")
    return (lookup(fps, labels, ["fp"], "n", fps.count())
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
