"""Token counts of sections from one encoding of the whole document.

A document is encoded once, whole. Every token has a character span; spans and section spans are
joined as intervals. Allocation rule: a token belongs to the section it shares most characters with,
ties to the earlier one; a token that touches no section (a bare separator) belongs to the last
section that starts at or before it, else to the first. So the sections' counts add up to the document's.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: how this vocabulary splits a text before merging
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# fixed value: what the vocabulary's splitting takes as white space
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 50_000        # white space characters in a row that the splitting is spared


class Encoder:
    """Byte-level BPE of a rank file's content, with token spans."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.n_bytes = np.zeros(max(table.values()) + 1, dtype=np.int64)
        self.n_bytes[list(table.values())] = [len(k) for k in table]

    def encode(self, text: str) -> list[int]:
        """The token ids of a text. The splitting's look-ahead fails on very long runs of white space; such a run is one
        piece, up to its last character if something follows, and is merged as one."""
        ids: list[int] = []
        at = 0
        for m in re.finditer(f"[{WHITE}]{{{LONG_RUN},}}", text):
            stop = m.end() - (m.end() < len(text))
            ids += self.encoding.encode_ordinary(text[at:m.start()])
            ids += self.encoding._encode_single_piece(text[m.start():stop].encode())
            at = stop
        return ids + self.encoding.encode_ordinary(text[at:])

    def spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First character and end (exclusive) of every token of the texts laid end to end; each text is
        encoded by itself. A token of part of a character covers it."""
        ids = np.concatenate([np.array(self.encode(t), dtype=np.int64) for t in texts])
        ends = np.cumsum(self.n_bytes[ids])
        starts = ends - self.n_bytes[ids]
        if sum(map(len, texts)) != (ends[-1] if len(ends) else 0):     # not pure ASCII: bytes to characters
            raw = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
            char = np.cumsum((raw & 0xC0) != 0x80) - 1
            return char[starts], char[ends - 1] + 1
        return starts, ends


_SECTION_END = re.compile(r"(?:[.!?]+\s|\n)\s*")


def sentence_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the sentences and lines of a text, the white space after them included: they cover it
    without gaps (an empty text is one empty section)."""
    cuts = [m.end() for m in _SECTION_END.finditer(text)]
    if cuts and cuts[-1] == len(text):
        cuts.pop()
    return np.array([0, *cuts], dtype=np.int64), np.array([*cuts, len(text)], dtype=np.int64)


def allocate(starts: np.ndarray, ends: np.ndarray, sec_starts: np.ndarray, sec_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of every token by the rule above, and whether the token reaches over a section's boundary.
    Sections are sorted and do not overlap."""
    # zero-length sections hold no character; the interval join runs over the others
    full = np.flatnonzero(sec_ends > sec_starts)
    a, b = sec_starts[full], sec_ends[full]
    first = np.searchsorted(b, starts, side="right")           # first section that ends after the token starts
    last = np.searchsorted(a, ends, side="left") - 1           # last section that starts before the token ends
    before = np.maximum(np.searchsorted(sec_starts, starts, side="right") - 1, 0)
    owner = before.copy()
    touching = first <= last
    owner[touching] = full[first[touching]]
    two = np.flatnonzero(touching & (first + 1 == last))
    left = b[first[two]] - np.maximum(a[first[two]], starts[two])
    right = np.minimum(b[last[two]], ends[two]) - a[last[two]]
    owner[two] = full[np.where(right > left, last[two], first[two])]
    for i in np.flatnonzero(touching & (first + 1 < last)):     # over three or more sections
        k = np.arange(first[i], last[i] + 1)
        share = np.minimum(b[k], ends[i]) - np.maximum(a[k], starts[i])
        owner[i] = full[k[int(np.argmax(share))]]
    crosses = touching.copy()
    at = np.searchsorted(full, owner[touching])
    crosses[touching] = (starts[touching] < a[at]) | (ends[touching] > b[at])
    return owner, crosses


def _groups(texts: list[str], characters: int = 500_000) -> Iterator[list[int]]:
    """Runs of row numbers with about so many characters."""
    rows: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        rows.append(i)
        size += len(t) + 100
        if size >= characters:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _counts(encoder: Encoder, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    """The result rows of some documents: one interval join with the texts laid end to end."""
    sections = [sentence_sections(t) for t in texts]
    n = np.array([len(a) for a, _ in sections])
    base = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]])
    first = np.repeat(base, n)
    sec_starts, sec_ends = (np.concatenate([x[k] for x in sections]) for k in (0, 1))
    owner, crosses = allocate(*encoder.spans(texts), sec_starts + first, sec_ends + first)
    counts = [np.bincount(o, minlength=len(first)) for o in (owner, owner[crosses])]
    place = np.arange(len(first)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    doc = ids.take(pa.array(np.repeat(np.arange(len(texts)), n)))
    return pa.RecordBatch.from_arrays([doc, *map(pa.array, (place, sec_starts, sec_ends, *counts))],
                                      names=["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])


def section_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks_path: str = RANKS) -> DataFrame:
    """One row per section (sentence or line) of every document: doc_id, section (from 0), start and end (characters), n_tokens, n_crossing
    (those of them that reach over its boundary).

    A null or empty text is one empty section without tokens; texts and runs of white space may have any length. Repeated rows are counted each; other columns are
    not read. The rank file is read where the driver runs and sent to the tasks (its size is the vocabulary's)."""
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(shared.value)
            ids, texts = batch.column(0), as_text(batch.column(1))
            for rows in _groups(texts):
                yield _counts(encoder, ids.take(pa.array(rows)), [texts[i] for i in rows])
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    return rows.mapInArrow(run, "doc_id long, section long, start long, end long, n_tokens long, n_crossing long")
