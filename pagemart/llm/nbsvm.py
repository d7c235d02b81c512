"""Quality classifier: a linear hinge-loss model on n-gram indicators scaled by Naive Bayes log-count
ratios (NB-SVM), fitted by dual coordinate descent.

Training reads a bounded sample of labelled documents (``per_class`` of either label, those
whose id hashes lowest); that bound is the only one. Every document is scored, whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each_text, map_batches, returning

DIMENSIONS = 1 << 20
PER_CLASS = 3000
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE_TOKENS = 100_000   # about 15 MB of a worker


class Features:
    """Hashed n-gram indicators of a text: token 1- and 2-grams, and 3-grams of token shapes (lower,
    capital, upper case, digits, the symbols themselves, or "as the token before")."""

    def __init__(self) -> None:
        self.cache: dict[str, int] = {}     # hash, and the shape above its 32 bits

    def _token(self, token: str) -> int:
        h = zlib.crc32(token.encode("utf-8", "replace"))
        if not (token[0].isalnum() or token[0] == "_"):
            shape = h
        elif token.isalpha():
            shape = 1 if token.islower() else 2 if not token.isupper() or len(token) == 1 else 3
        else:
            shape = 4
        if len(self.cache) >= _CACHE_TOKENS:
            self.cache.clear()
        self.cache[token] = both = shape << 32 | h
        return both

    def __call__(self, text: str) -> np.ndarray:
        tokens = _TOKEN.findall(text)
        if not tokens:
            return np.zeros(0, dtype=np.int32)
        get, new = self.cache.get, self._token
        both = np.array([get(t) or new(t) for t in tokens], dtype=np.uint64)
        word, shape = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
        shape[1:][word[1:] == word[:-1]] = 5
        grams = [word * np.uint64(0x9E3779B97F4A7C15),
                 (word[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (word[1:] * np.uint64(0x165667B19E3779F9)),
                 (shape[:-2] * np.uint64(0x27D4EB2F165667C5)) ^ (shape[1:-1] * np.uint64(0x85EBCA77C2B2AE63))
                 ^ (shape[2:] * np.uint64(0xFF51AFD7ED558CCD))]
        return np.unique(np.concatenate(grams) >> np.uint64(44)).astype(np.int32)


@dataclass
class Model:
    """margin = sum(weight[x]) / sqrt(sum(square[x])) + bias; score = sigmoid(slope * margin + shift)."""
    weight: np.ndarray
    square: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> float:
        norm = float(self.square[x].sum())
        return (float(self.weight[x].sum()) / norm ** 0.5 if norm > 0 else 0.0) + self.bias

    def score(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -50, 50))))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """log of the smoothed share of each indicator in class 1 over that in class -1."""
    counts = []
    for label in (1, -1):
        ids = [r for r, k in zip(rows, y, strict=True) if k == label]
        c = np.bincount(np.concatenate(ids) if ids else [], minlength=DIMENSIONS).astype(float) + alpha
        counts.append(c / c.sum())
    ratio = np.log(counts[0] / counts[1])
    seen = np.zeros(DIMENSIONS, dtype=bool)
    for r in rows:
        seen[r] = True
    return np.where(seen, ratio, 0.0)


def dual_coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = 1.0,
                            epochs: int = 30, seed: int = 13) -> tuple[np.ndarray, float]:
    """min over w of |w|^2 / 2 + cost * sum(max(0, 1 - y w.x)), x = unit-length ratio-scaled indicators and a constant
    1: one dual variable at a time in [0, cost], in a random order per epoch."""
    rng, alpha = np.random.default_rng(seed), np.zeros(len(rows))
    w, bias = np.zeros(DIMENSIONS), 0.0
    values = []
    for r in rows:
        v = ratio[r]
        norm = float(np.sqrt(v @ v))
        values.append(v / norm if norm > 0 else v)
    diagonal = [float(v @ v) + 1.0 for v in values]
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = y[i] * (float(w[r] @ v) + bias) - 1
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * v
                bias += step
                largest = max(largest, abs(step))
                alpha[i] = new
        if largest < 1e-3:
            break
    return w, bias


def calibrate(margins: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Platt scaling (smoothed targets, Newton steps): slope and shift of the sigmoid."""
    pos, neg = float((y > 0).sum()), float((y < 0).sum())
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * beta), -5, 5)
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Model of 0/1 ``labels``. Every fourth row is kept for the calibration. Without both labels the
    model scores every text 0.5."""
    y = np.where(labels > 0, 1, -1)
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[~held])) < 2:
        return Model(np.zeros(DIMENSIONS, np.float32), np.zeros(DIMENSIONS, np.float32))
    train = [r for r, h in zip(rows, held, strict=True) if not h]
    ratio = log_count_ratio(train, y[~held])
    w, bias = dual_coordinate_descent(train, ratio, y[~held])
    model = Model((w * ratio).astype(np.float32), (ratio ** 2).astype(np.float32), bias)
    margins = np.array([model.margin(r) for r, h in zip(rows, held, strict=True) if h])
    model.slope, model.shift = calibrate(margins, y[held])
    return model


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 3: remainder 1 is held out from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3, F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(rank, text, y) of at most ``per_class`` documents of either label outside the held-out fold. Ids
    labelled both ways are left out; an id with several texts teaches by the first in byte order."""
    ids = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != 1)).groupBy("doc_id")
           .agg(F.min(label).alias("y"), F.max(label).alias("y2")).where("y = y2").drop("y2")
           .withColumn("rank", F.xxhash64("doc_id")))
    picked = [ids.where(F.col("y") == k).orderBy("rank", "doc_id").limit(per_class) for k in (0, 1)]
    few = picked[0].unionByName(picked[1])     # at most 2 * per_class rows
    found = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    return found.groupBy("rank", "y").agg(F.min("text").alias("text")).select("rank", "text", "y")      # one text per id, however often it comes


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        features = Features()
        x = [features(t) for t in each_text(b.column(1))]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.int32())), b.column(2)], names=["rank", "x", "y"])
    sample = map_batches(labelled_sample(docs, labels, label, per_class)
                         .select("rank", F.col("text").cast("binary"), F.col("y").cast("int")),
                         run, "rank long, x array<int>, y int").toArrow().sort_by("rank")
    rows = [np.asarray(r.values, dtype=np.int32) for r in sample.column("x")]
    return fit(rows, sample.column("y").to_numpy())


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (1 if score >= 0.5).

    Only ids outside the held-out fold teach; label, language, source and id are never inputs of a
    score. A null or empty text is scored by the constant alone. Without labels of both classes every score is 0.5.
    Repeated rows are scored each. All columns of ``docs`` stay, except ones named like the three results."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(train(docs, labels, label, per_class)))
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    schema = docs.select(*kept).schema

    at = [c.lower() for c in kept].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, features = Model(*shared.value), Features()
        for b in batches:
            score = np.array([model.score(features(t)) for t in each_text(b.column(at))], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=[*kept, "score"])
    # the text crosses once: as a string it is not looked into before each_text takes its bytes
    out = docs.select(*kept).mapInArrow(returning(run), schema.add("score", "double"))
    return (out.withColumn("held_out", fold() == 1)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
