"""Substring deduplication by sliding sentence spans.

A text is cut into sentences (lines end sentences; a sentence of more than ``MAX_WORDS`` words is cut into
pieces from its start). From every sentence on, the shortest run of at least two sentences that holds ``MIN_WORDS``
words is hashed (128 bits of the words, white space made uniform), and so is the shortest such run that ends at every
sentence: together they cover all a longer run would, its tail too. Runs are joined over all documents; every sentence
covered by a run that is not its first occurrence is removed.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_text, doc_key, lookup, settle, sheltered

MIN_SENTENCES = 2
MIN_WORDS = 20
MAX_WORDS = 20           # longer sentences are cut
CUT_WORDS = 16            # before one word in so many
_SENTENCE_END = re.compile(r"(?:[.!?]+\s|\n)\s*")
_WORD = re.compile(r"\S+")


def content_cuts(words: list[str]) -> list[int]:
    """Where a long sentence is cut: before words whose hash falls on a residue, and where a piece would exceed ``MAX_WORDS``. The places
    depend on the words, not on the sentence's start, so they come back wherever a passage without sentence ends stands."""
    cuts, last = [], 0
    for i in range(1, len(words)):
        if zlib.crc32(words[i].encode("utf-8", "replace")) % CUT_WORDS == 0 or i - last >= MAX_WORDS:
            cuts.append(i)
            last = i
    return cuts


def sentences(text: str) -> tuple[list[tuple[int, int]], list[list[str]]]:
    """Character spans (the white space after a sentence included) and words of the sentences of a text."""
    spans: list[tuple[int, int]] = []
    words: list[list[str]] = []
    at = 0
    for end in [*(m.end() for m in _SENTENCE_END.finditer(text)), len(text)]:
        found = text[at:end].split()
        if len(found) > MAX_WORDS:
            cuts = content_cuts(found)
            begins = [at + m.start() for m in _WORD.finditer(text[at:end])]
            starts = [begins[i] for i in cuts]
            spans += zip([at, *starts], [*starts, end], strict=True)
            words += [found[i:j] for i, j in zip([0, *cuts], [*cuts, len(found)], strict=True)]
        elif found:
            spans.append((at, end))
            words.append(found)
        at = end
    return spans, words


def runs(words: list[list[str]]) -> Iterator[tuple[int, int]]:
    """(first sentence, number of sentences) of the shortest run that starts at each sentence and of the shortest that ends
    at each, as far as there is one; each run once."""
    n, j, held = len(words), 0, 0
    shortest = {}
    for i in range(n):
        while j < n and (j - i < MIN_SENTENCES or held < MIN_WORDS):
            held += len(words[j])
            j += 1
        if j - i < MIN_SENTENCES or held < MIN_WORDS:
            break
        shortest[i] = j - i
        yield i, j - i
        held -= len(words[i])
    i, held = 0, 0
    for j in range(1, n + 1):
        held += len(words[j - 1])
        while j - i > MIN_SENTENCES and held - len(words[i]) >= MIN_WORDS:
            held -= len(words[i])
            i += 1
        if j - i >= MIN_SENTENCES and held >= MIN_WORDS and shortest.get(i) != j - i:
            yield i, j - i


def span_places(keyed: DataFrame) -> DataFrame:
    """(k_id, k_text, at, n, h, h2) of all runs of documents (k_id, k_text, text as binary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k_id", "k_text", "at", "n", "h", "h2"]
        for b in batches:
            ids = [b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            texts = as_text(b.column(2))
            for first in range(0, len(texts), 500):
                rows, at, n, digests = [], [], [], []
                for r, t in enumerate(texts[first:first + 500], first):
                    words = sentences(t)[1]
                    joined = [" ".join(w) for w in words]
                    for i, k in runs(words):
                        rows.append(r)
                        at.append(i)
                        n.append(k)
                        digests.append(xxhash.xxh3_128_digest(" ".join(joined[i:i + k]).encode("utf-8", "replace")))
                h = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                pick = np.array(rows, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[0][pick]), pa.array(ids[1][pick]), pa.array(at, pa.int32()), pa.array(n, pa.int32()),
                     pa.array(h[:, 0]), pa.array(h[:, 1])], names=names)
    return keyed.mapInArrow(run, "k_id long, k_text long, at int, n int, h long, h2 long")


def _without(text: str, gone: list[tuple[int, int]]) -> tuple[str, int, int, list[dict[str, int]]]:
    """The text without the sentences of the runs ``gone``; its sentences, those removed, the character spans removed."""
    spans, _ = sentences(text)
    drop = np.zeros(len(spans) + 1, dtype=bool)
    for i, n in gone:
        drop[i:i + n] = True
    kept, cut, at = [], [], 0
    for (a, b), d in zip(spans, drop, strict=False):
        if d:
            kept.append(text[at:a])
            if cut and cut[-1]["end"] == a:
                cut[-1]["end"] = b
            else:
                cut.append({"start": a, "end": b})
            at = b
    kept.append(text[at:])
    return "".join(kept), len(spans), int(drop.sum()), cut


def remove_repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` freed of repeated passages, n_sentences, n_removed and removed (character spans in the
    text as it was).

    The first occurrence by (id, text hash, place) stays; null ids come first. A null text stays null with
    no sentences; texts without a run stay as they are. Repeated rows are one document: all of them keep or lose the same
    sentences. Columns of ``docs`` named like the results are replaced; all others stay, whatever their names. Texts may have any
    length."""
    results = ("n_sentences", "n_removed", "removed")
    names = [c for c in docs.columns if c not in results]
    docs, (doc_id, text) = sheltered(docs.select(*names), doc_id, text)
    key, hashes = ["k_id", "k_text"], ["h", "h2"]
    keyed = docs.select(*doc_key(doc_id, text), F.col(text).cast("binary").alias("t"))
    places = settle(span_places(keyed), "span-places")
    place = F.struct("k_id", "k_text", "at")
    again = (places.groupBy(*hashes).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1"))
    again = settle(again, "span-again")
    late = lookup(places, again, hashes, "copies", places.count()).where(place != F.col("first"))
    gone = settle(late.groupBy(*key).agg(F.collect_set(F.struct("at", "n")).alias("gone")), "span-gone")

    kept = docs.columns
    joined = docs.select(*kept, *doc_key(doc_id, text)).join(gone.hint("merge"), key, "left").select(*kept, "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = kept.index(text)
        for b in batches:
            lists = [[(x["at"], x["n"]) for x in g] if g else [] for g in b.column(len(kept)).to_pylist()]
            out = [_without(t, g) for t, g in zip(as_text(b.column(where)), lists, strict=True)]
            texts = pa.array([None if null else o[0] for o, null in zip(out, b.column(where).is_null().to_pylist(), strict=True)], pa.string())
            columns = [*b.columns[:-1], pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.int32()),
                       pa.array([o[3] for o in out], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
            columns[where] = texts
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *results])
    spans = T.ArrayType(T.StructType().add("start", "integer").add("end", "integer"))
    schema = docs.select(*kept).schema.add("n_sentences", "integer").add("n_removed", "integer").add("removed", spans)
    return joined.mapInArrow(run, schema).toDF(*names, *results)
