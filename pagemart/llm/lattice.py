"""SentencePiece encoding and decoding over a relational lattice.

The distinct words of all texts are a table. Their substrings of bounded length are exploded and equi-joined to the
piece table (broadcast: its size is the vocabulary's); the matches are the edges of the words' lattices, grouped by word, and a
Spark higher-order ``aggregate`` folds each lattice to its best path. The model's pieces carry merge
ranks (BPE), for which the path of highest score sum is not what the tokenizer returns; so the fold takes the edges in the tokenizer's
order: at each step the adjacent pair that spans the best-scored edge is joined, the leftmost on ties.

Documents are taken in blocks of neighbouring rows and split once: a block holds its distinct words and its texts as numbers of them.
Words are dealt into buckets. Every block asks each bucket for its words there, in one packed row, and gets their ids back in that order, so
neither words nor ids travel as rows of their own, and no text travels. One way serves all words, frequent or rare.
"""

from __future__ import annotations

import heapq
import io
import pickle
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_text, returning

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
BLOCK_BYTES = 8 << 20   # text per block of documents, about; a longer document is a block of its own
FOUND_BYTES = 256 << 10 # text whose words are Python strings at once, about
SLICE_UNITS = 400_000   # words of a block turned into ids at once, about
LEAST_BUCKETS = 256     # of words; more if more partitions are shuffled
FOLD_LENGTH = 60        # characters; longer words are folded with a heap instead of the SQL aggregate

# a word: the spaces before it and a run of letters, or of anything else (numerals that re counts as \w are no letters)
_NUMERALS = "\u00b2\u00b3\u00b9\u00bc-\u00be\u2070-\u209c\u2150-\u218b\u2460-\u24ff"
_LETTERS = f"[^\\W\\d_{_NUMERALS}]"
WORD = re.compile(f" *(?:{_LETTERS}+|(?:[^\\w ]+|[\\d_{_NUMERALS}]+)+)| +")
_LETTER = re.compile(_LETTERS)


def piece_table(model_path: str = MODEL) -> tuple[list[tuple[str, int, float]], int, list[bytes]]:
    """(piece, id, score) of the pieces that merge, with plain spaces, the id of byte 0, and every id's bytes for decoding."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    pieces = [(sp.id_to_piece(i).replace(SPACE, " "), i, float(sp.get_score(i))) for i in plain]
    for p, _, _ in pieces:
        if any(b == " " != a or a != " " and bool(_LETTER.match(a)) != bool(_LETTER.match(b)) for a, b in zip(p, p[1:], strict=False)):
            raise ValueError(f"piece {p!r} reaches over a word boundary")
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if byte_ids != list(range(byte_ids[0], byte_ids[0] + 256)):
        raise ValueError("the byte pieces are not in a row")
    spelled = [b""] * n
    for p, i, _ in pieces:
        spelled[i] = p.encode()
    for b, i in enumerate(byte_ids):
        spelled[i] = bytes([b])
    return pieces, byte_ids[0], spelled


def words_of(text: str) -> list[str]:
    """The words of a text behind the tokenizer's leading space; the model's visible space counts as a space."""
    return WORD.findall(" " + (text.replace(SPACE, " ") if SPACE in text else text)) if text else []


def heap_path(word: str, known: dict[str, tuple[int, float]], longest: int) -> list[int]:
    """The same path as the SQL fold, for long words: boundaries left after joining the best pairs first."""
    n = len(word)
    end, left, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[float, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n and end[end[i]] - i <= longest and (e := known.get(word[i:end[end[i]]])):
            heapq.heappush(heap, (-e[1], i, end[i], end[end[i]]))
    for i in range(n):
        offer(i)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        if alive[i] and end[i] == middle and end[middle] == stop:
            alive[middle], end[i] = False, stop
            if stop < n:
                left[stop] = i
            offer(i)
            offer(left[i])
    return [i for i in range(n) if alive[i]] + [n]


def _heap_ids(word: str, known: dict[str, tuple[int, float]], longest: int, byte0: int) -> list[int]:
    b = heap_path(word, known, longest)
    return [x for s, e in zip(b, b[1:], strict=False) for x in (
        [known[word[s:e]][0]] if word[s:e] in known else [byte0 + c for c in word[s:e].encode()])]


def encode_words(words: DataFrame, pieces: list[tuple[str, int, float]], byte0: int) -> DataFrame:
    """``words(bucket, word)``, one row per word of at most ``FOLD_LENGTH`` characters and partitioned by bucket, with ids array<int>: the lattice and its fold.

    An edge is one number: score rank, place, length and id from the highest bits down, so sorted edges come in the order in
    which the tokenizer merges. The fold's state has a bit per place between characters that still is a boundary (and the sign, once
    nothing can be joined). An edge joins a pair if both its ends are boundaries and exactly one boundary lies inside; the
    first such edge is the next merge."""
    spark = words.sparkSession
    longest = max(len(p) for p, _, _ in pieces)
    if longest > 31 or max(i for _, i, _ in pieces) >= 1 << 20:
        raise ValueError("pieces of up to 31 characters and ids below 2^20 are expected")
    rank = {v: r for r, v in enumerate(sorted({-v for _, _, v in pieces}))}
    # the empty substring is an edge of no length at place 0, so that a word without any matching piece keeps a row
    rows = [("", 0), *((p, (rank[-v] << 31) + i) for p, i, v in pieces)]
    # as an Arrow table, which starts no Python workers of a second kind beside those of the other steps
    table = F.broadcast(spark.createDataFrame(pa.table(dict(zip(("piece", "code"), map(list, zip(*rows, strict=True)), strict=True)))))
    n = "char_length(word)"
    cuts = (words.select("bucket", "word", F.explode(F.expr(f"sequence(0, {n} - 1)")).alias("s"))
            .select("bucket", "word", "s", F.explode(F.expr(f"sequence(if(s = 0, 0, 1), least({longest}, {n} - s))")).alias("l"))
            .select("bucket", "word", F.expr("s * 33554432L + l * 1048576L").alias("at"), F.expr("substring(word, s + 1, l)").alias("piece")))
    edges = cuts.join(table, "piece").select("bucket", "word", (F.col("code") + F.col("at")).alias("e"))
    grouped = edges.groupBy("bucket", "word").agg(F.sort_array(F.collect_list("e")).alias("edges"))
    lattice = grouped.withColumn("n", F.char_length("word"))

    def let(name: str, value: str, body: str) -> str:
        """``body`` with ``value`` computed once; a column of an earlier select would be put into every lambda call."""
        return f"get(transform(array({value}), {name} -> {body}), 0)"
    place, length = "cast(shiftright(e, 25) & 63 AS int)", "cast(shiftright(e, 20) & 31 AS int)"
    at_id = "shiftright(e, 25) % 64 * 1048576L + (e & 1048575)"
    pairs = f"""transform(filter(edges, e -> (shiftright(e, 20) & 31) > 1), e -> struct(
                  shiftleft(shiftleft(1L, {length} + 1) - 1, {place}) AS span,
                  shiftleft(1L, {place}) | shiftleft(1L, {place} + {length}) AS ends,
                  shiftleft(shiftleft(1L, {length} - 1) - 1, {place} + 1) AS inside, {at_id} AS at_id))"""
    joined = "get(filter(pairs, e -> bit_count(m & e.span) = 3 AND (m & e.ends) = e.ends), 0).inside"
    fold = f"""aggregate(sequence(1, n), shiftleft(1L, n + 1) - 1L,
                 (m, x) -> if(m < 0, m, coalesce(m & ~{joined}, m | shiftleft(1L, 63))), m -> m & {2**63 - 1}L)"""
    # edges of the path: both ends are boundaries, none lies inside; a character without an edge is spelled in bytes
    taken = f"""concat(transform(filter(pairs, e -> bit_count(path & e.span) = 2 AND (path & e.ends) = e.ends), e -> e.at_id),
                  transform(filter(edges, e -> (shiftright(e, 20) & 31) = 1 AND (shiftright(path, {place}) & 3L) = 3), e -> {at_id}))"""
    spell = let("h", "hex(substring(word, a + 1, 1))", f"transform(sequence(0, length(h) div 2 - 1), j -> "
                f"{byte0} + cast(conv(substring(h, 2 * j + 1, 2), 16, 10) AS int))")
    span = "transform(filter(edges, e -> (shiftright(e, 20) & 2047) = a * 32 + b[i + 1] - a), e -> cast(e & 1048575 AS int))"
    mixed = let("b", "filter(sequence(0, n), i -> (shiftright(path, i) & 1L) = 1)",
                "flatten(transform(slice(b, 1, size(b) - 1), (a, i) -> " + let("one", span, f"if(size(one) = 1, one, {spell})") + "))")
    ids = let("pairs", pairs, let("path", fold, let("taken", taken,
              f"if(size(taken) = bit_count(path) - 1, transform(sort_array(taken), e -> cast(e & 1048575 AS int)), {mixed})")))
    return lattice.select("bucket", "word", F.expr(ids).alias("ids"))


def _blocks(batches: Iterator[pa.RecordBatch], text: int, block_bytes: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a task in blocks, each with its number: partition and place. Where a block ends depends on the rows alone."""
    part, held, size, at = TaskContext.get().partitionId(), [], 0, 0

    def block() -> tuple[int, pa.RecordBatch]:
        return (part << 32) + at, pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    for b in batches:
        while b.num_rows:
            sums = size + np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            stop = int(np.searchsorted(sums, block_bytes)) + 1
            if stop > b.num_rows:
                held.append(b.take(pa.array(np.arange(b.num_rows))))     # a copy, so that the batch it ends can go before the next one comes
                size = int(sums[-1])
                break
            held.append(b.slice(0, stop))
            yield block()
            held, size, at, b = [], 0, at + 1, b.slice(stop)
        del b
    if held:
        yield block()


def _texts(column: pa.Array) -> pa.StringArray:
    """The texts of a binary column; null is empty, broken UTF-8 becomes U+FFFD."""
    try:
        return pc.fill_null(column.cast(pa.string()), "")
    except pa.ArrowInvalid:
        return pa.array(as_text(column), pa.string())


def _listed(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """``values`` cut into lists of ``counts`` values each."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _sums(counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of runs of ``lengths`` counts each."""
    sums, ends = np.zeros(len(counts) + 1, np.int64), np.cumsum(lengths)
    np.cumsum(counts, out=sums[1:])
    return np.diff(sums[np.concatenate([[0], ends])])


def _parts(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and bytes of strings (none is null)."""
    if not len(strings):
        return np.zeros(0, np.int32), np.zeros(0, np.uint8)
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[strings.offset:strings.offset + len(strings) + 1]
    return np.diff(at), np.frombuffer(data or b"", dtype=np.uint8)[at[0]:at[-1]]


def _strings(lengths: np.ndarray, data: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Strings from their lengths and bytes."""
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(kind, len(lengths), [None, pa.py_buffer(at), pa.py_buffer(data)])


def _joined(strings: pa.Array, lengths: np.ndarray) -> pa.Array:
    """Runs of ``lengths`` strings each, laid end to end."""
    own, data = _parts(strings)
    return _strings(_sums(own, lengths), data, strings.type)


def _pressed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers in few bytes: their lowest bytes, then the next ones, and so on, compressed."""
    codec = pa.Codec("zstd", compression_level=3)
    planes = [np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T) for x in arrays]
    return pickle.dumps([(x.dtype.str, len(x), codec.compress(p, asbytes=True) if len(x) else b"") for x, p in zip(arrays, planes, strict=True)])


def _unpressed(data: bytes) -> list[np.ndarray]:
    codec, out = pa.Codec("zstd"), []
    for kind, n, packed in pickle.loads(data):
        size = np.dtype(kind).itemsize
        raw = np.frombuffer(codec.decompress(packed, n * size), dtype=np.uint8) if n else np.zeros(0, np.uint8)
        out.append(np.ascontiguousarray(raw.reshape(size, n).T).view(kind).reshape(n))
    return out


def _found(texts: pa.StringArray, find: Callable[[str], list[str]]) -> tuple[list[pa.StringArray], np.ndarray]:
    """The words that ``find`` finds in texts, in a row, and how many each text has. About 256 KB of texts are Python strings at once; they take ten
    times the room of Arrow's."""
    arrays, counts, first = [], [np.zeros(0, np.int32)], 0
    ends = np.cumsum(_parts(texts)[0], dtype=np.int64)
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + FOUND_BYTES, side="right")))
        lists = [find(t) for t in texts.slice(first, last - first).to_pylist()]
        arrays.append(pa.array([w for f in lists for w in f], pa.string()))
        counts.append(np.array([len(f) for f in lists], np.int32))
        first = last
    return arrays, np.concatenate(counts)


def _numbered(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """Texts as numbers of words in a row, how many each text has, and the distinct words, frequent ones first. A text with single spaces only is
    split at them first, and the words of what stands between two spaces are found once."""
    odd = pc.or_(pc.or_(pc.equal(texts, ""), pc.starts_with(texts, " ")), pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, SPACE)))
    split = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
    n_split, flat = pc.list_value_length(split).to_numpy(zero_copy_only=False), split.flatten().dictionary_encode()
    del split
    # plain letters are one word; the pattern sees to the others
    plain = pc.ascii_is_alpha(flat.dictionary)
    one = pc.binary_join_element_wise(pa.scalar(""), flat.dictionary.filter(plain), " ")
    found, n_found = _found(flat.dictionary.filter(pc.invert(plain)), lambda t: WORD.findall(" " + t))
    others, n_others = _found(texts.filter(odd), words_of)
    words = pa.chunked_array([one, *found, *others], pa.string()).combine_chunks().dictionary_encode()
    words, number = words.dictionary, words.indices.to_numpy(zero_copy_only=False)
    del found, others
    counts = np.concatenate([np.ones(len(one), np.int32), n_found])
    n_inside = int(counts.sum())
    # what stands between spaces, as it comes in the texts: its place among the plain ones and the others behind them, and its words
    is_plain, is_odd = (x.to_numpy(zero_copy_only=False) for x in (plain, odd))
    place = np.where(is_plain, np.cumsum(is_plain) - 1, len(one) + np.cumsum(~is_plain) - 1).astype(np.int32)[flat.indices.to_numpy(zero_copy_only=False)]
    inside = _listed(pa.array(number[:n_inside]), counts).take(pa.array(place)).flatten().to_numpy(zero_copy_only=False)
    codes, lengths = np.concatenate([inside, number[n_inside:]]), np.zeros(len(texts), np.int32)
    del flat, inside
    lengths[~is_odd] = _sums(counts[place], n_split)
    lengths[is_odd] = n_others
    del place
    if is_odd.any():                    # back into the order of the texts
        order = np.concatenate([np.flatnonzero(~is_odd), np.flatnonzero(is_odd)])
        codes = _listed(pa.array(codes), lengths[order]).take(pa.array(np.argsort(order))).flatten().to_numpy(zero_copy_only=False)
    often = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    return np.argsort(often).astype(np.int32)[codes], lengths, words.take(pa.array(often))


def _buckets(words: pa.StringArray, n: int) -> np.ndarray:
    """A number below ``n`` for every word, from its bytes alone."""
    lengths, data = _parts(words)
    if not len(lengths):
        return np.zeros(0, np.int32)
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    powers = np.multiply.accumulate(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, dtype=np.uint64))
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(data)) - np.repeat(starts, lengths)], starts)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(33)) % np.uint64(n)).astype(np.int32)


def _asked(words: pa.StringArray, n: int) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, np.ndarray]]]:
    """Of each bucket the words of at most ``FOLD_LENGTH`` characters: bucket, places among all words, lengths and bytes."""
    short = np.flatnonzero(pc.less_equal(pc.utf8_length(words), FOLD_LENGTH).to_numpy(zero_copy_only=False))
    buckets = _buckets(words.take(pa.array(short)), n)
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order])) + 1
    for found in np.split(order, cuts) if len(order) else []:
        yield int(buckets[found[0]]), short[found], _parts(words.take(pa.array(short[found])))


def _mark(lengths: np.ndarray, data: np.ndarray) -> int:
    """A checksum of asked words, by which an answer is known to be theirs."""
    return zlib.crc32(np.ascontiguousarray(data), zlib.crc32(lengths.astype(np.int32)))


def _packed(rows: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as w:
        w.write_batch(rows)
    return out.getvalue()


def _without_space(texts: pa.Array) -> pa.StringArray:
    """Decoded bytes as texts, without the tokenizer's leading space."""
    lengths, data = _parts(texts)
    starts = (np.cumsum(lengths, dtype=np.int64) - lengths)[lengths > 0]
    stay = np.ones(len(data), dtype=bool)
    stay[starts] = data[starts] != ord(" ")
    lengths = lengths.copy()
    lengths[lengths > 0] -= ~stay[starts]
    return _texts(_strings(lengths, data[stay], texts.type))


def _spell(spelled: dict[int, bytes], ids: list[int]) -> str:
    """The text of some ids: their bytes in a row, without the tokenizer's leading space."""
    return b"".join([spelled.get(i, b"") for i in ids]).decode("utf-8", "replace").removeprefix(" ")


def encode(docs: DataFrame, text: str = "text", model_path: str = MODEL, decoded: str | None = None, drop_text: bool = False) -> DataFrame:
    """``docs`` with ids array<int> and n_tokens, as the model's own encoder gives them (no begin or end marks). ``decoded`` names a column
    for the text that the ids decode to (as ``decode`` gives it), made where the ids are; ``drop_text`` leaves the text itself out.

    A null or empty text has no ids. Characters without a piece become byte pieces. Repeated rows are encoded each; texts may have any
    length a row can hold. Columns named ids or n_tokens are replaced; all others stay, whatever their names."""
    spark = docs.sparkSession
    pieces, byte0, spelled_ids = piece_table(model_path)
    results = ["ids", "n_tokens", *([decoded] if decoded else [])]
    docs = docs.drop(*results)
    where = docs.columns.index(text)
    # plain names while the rows travel, so that no name can clash
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).withColumn(f"c{where}", F.col(f"c{where}").cast("binary"))
    kept = [i for i in range(len(docs.columns)) if not (drop_text and i == where)]
    n_parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(LEAST_BUCKETS, 2 * n_parts)
    block_bytes, slice_words = BLOCK_BYTES, SLICE_UNITS
    known = {p: (i, v) for p, i, v in pieces}
    longest = max(len(p) for p, _, _ in pieces)
    spellings = pa.array(spelled_ids, pa.binary())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches, where, block_bytes):
            codes, lengths, words = _numbered(_texts(rows.column(where)))
            columns = [*(rows.column(i) for i in kept), pa.array(lengths)]
            held = _packed(pa.RecordBatch.from_arrays(columns, names=[*(f"c{i}" for i in kept), "lengths"]))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *(pa.array([x], pa.binary()) for x in (held, _pressed(codes), _pressed(*_parts(words))))],
                                             names=["block", "rows", "codes", "words"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, words in zip(b.column(0).to_pylist(), b.column(3), strict=True):
                asked = [(k, _pressed(*x)) for k, _, x in _asked(_strings(*_unpressed(words.as_buffer()), pa.string()), n_buckets)]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in asked], pa.int32()), pa.array([block] * len(asked), pa.int64()),
                                                  pa.array([x for _, x in asked], pa.binary())], names=["bucket", "block", "words"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Most repeats go here, in bounded memory, the others by ``distinct``."""
        kept_ = pa.array([], pa.string())
        for b in batches:
            for first in range(0, b.num_rows, 200):
                new = pc.unique(pa.chunked_array([_strings(*_unpressed(x.as_buffer()), pa.string()) for x in b.column(2).slice(first, 200)], pa.string()))
                new = new.filter(pc.invert(pc.is_in(new, value_set=kept_)))
                kept_ = new if len(kept_) > 500_000 else pa.concat_arrays([kept_, new])
                yield pa.RecordBatch.from_arrays([pa.array(_buckets(new, n_buckets)), new], names=["bucket", "word"])

    def answer(asked: pa.Table, encoded: pa.Table) -> pa.Table:
        words, lists = (encoded.column(c).combine_chunks() for c in ("word", "ids"))
        n_ids = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int32)
        columns = [asked.column(c).combine_chunks() for c in ("block", "bucket", "words")]
        kept_, marks, answers, first = [], [], [], 0
        while first < asked.num_rows:           # so many rows at once that they hold as many words as the bucket, about
            held, size = [], 0
            while first + len(held) < asked.num_rows and size <= len(words):
                held.append(_unpressed(columns[2][first + len(held)].as_buffer()))
                size += len(held[-1][0])
            places = pc.index_in(_strings(*(np.concatenate(x) for x in zip(*held, strict=True)), pa.string()), value_set=words)
            at = np.cumsum([0, *(len(x) for x, _ in held)]).tolist()
            for i, (begin, end) in enumerate(zip(at, at[1:], strict=False)):
                own = places.slice(begin, end - begin)
                if not own.null_count:
                    kept_.append(first + i)
                    marks.append(_mark(*held[i]))
                    answers.append(_pressed(n_ids[own.to_numpy(zero_copy_only=False)], lists.take(own).flatten().to_numpy(zero_copy_only=False)))
            first += len(held)
        kept_ = pa.array(kept_, pa.int64())
        return pa.table([columns[0].take(kept_), columns[1].take(kept_), pa.array(marks, pa.int64()), pa.array(answers, pa.binary())],
                        names=["block", "bucket", "mark", "ids"])

    def assemble(held: pa.Table, answers: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()       # what the block before has left
        own = dict(zip(answers.column("bucket").to_pylist(), zip(answers.column("mark").to_pylist(), answers.column("ids"), strict=True), strict=True))
        return pa.Table.from_batches([part for row in zip(*(held.column(c) for c in ("rows", "codes", "words")), strict=True) for part in assembled(*row, own)])

    def assembled(packed: pa.Scalar, codes_: pa.Scalar, words_: pa.Scalar, own: dict[int, tuple[int, pa.Scalar]]) -> Iterator[pa.RecordBatch]:
        rows = pa.ipc.open_stream(packed.as_buffer()).read_next_batch()
        codes, words = _unpressed(codes_.as_buffer())[0], _strings(*_unpressed(words_.as_buffer()), pa.string())
        # the ids of every word, in the order in which the answers hold them
        places, counts, ids, left = [], [], [], np.ones(len(words), dtype=bool)
        for k, at, asked in _asked(words, n_buckets):
            mark, packed_ids = own.get(k, (None, None))
            if mark == _mark(*asked):
                for whole, part in zip((counts, ids), _unpressed(packed_ids.as_buffer()), strict=True):
                    whole.append(part)
                places.append(at)
                left[at] = False
        # words too long for the fold are not asked for; nor, if rows came in another order when they were read again, are a block's words
        rest = [_heap_ids(w, known, longest, byte0) for w in words.filter(pa.array(left)).to_pylist()]
        places.append(np.flatnonzero(left))
        counts.append(np.array([len(r) for r in rest], np.int32))
        ids.append(np.array([i for r in rest for i in r], np.int32))
        counts, ids = np.concatenate(counts), pa.array(np.concatenate(ids))
        row = np.empty(len(words), np.int32)
        row[np.concatenate(places)] = np.arange(len(words), dtype=np.int32)
        codes, lists = row[codes], _listed(ids, counts)
        said = _joined(spellings.take(ids), counts) if decoded else None
        lengths = rows.column(len(kept)).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(lengths, dtype=np.int64), 0
        while first < rows.num_rows:
            begin = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, begin + slice_words, side="right")))
            part, own_lengths = codes[begin:int(ends[last - 1])], lengths[first:last]
            n = _sums(counts[part], own_lengths).astype(np.int32)
            more = [_without_space(_joined(said.take(pa.array(part)), own_lengths))] if decoded else []
            docs_ = rows.slice(first, last - first)
            columns = [docs_.column(j) if i != where else docs_.column(j).view(pa.string()) for j, i in enumerate(kept)]
            yield pa.RecordBatch.from_arrays([*columns, _listed(lists.take(pa.array(part)).flatten(), n), pa.array(n), *more],
                                             names=[*(f"c{i}" for i in kept), *results])
            first = last
    schema = spark.createDataFrame([], plain.withColumn(f"c{where}", F.lit(None).cast("string")).schema).select(*[f"c{i}" for i in kept]) \
        .withColumns({"ids": F.lit(None).cast("array<int>"), "n_tokens": F.lit(None).cast("int"), **({decoded: F.lit(None).cast("string")} if decoded else {})}).schema
    # both shuffles below are made once and read twice
    held = plain.mapInArrow(returning(split), "block long, rows binary, codes binary, words binary").repartition("block")
    asked = held.mapInArrow(returning(ask), "bucket int, block long, words binary").repartition(n_parts, "bucket")
    # words grow a hundredfold in the lattice, so their partitions are not to be put together; sorted, the edges need no more sorting
    distinct = asked.mapInArrow(returning(once), "bucket int, word string").repartition(n_parts, "bucket").distinct().sortWithinPartitions("bucket", "word")
    encoded = encode_words(distinct, pieces, byte0)
    answers = asked.groupBy("bucket").cogroup(encoded.groupBy("bucket")).applyInArrow(answer, "block long, bucket int, mark long, ids binary")
    met = held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(assemble, schema)
    return met.toDF(*[docs.columns[i] for i in kept], *results)


def decode(encoded: DataFrame, ids: str = "ids", out: str = "decoded", model_path: str = MODEL) -> DataFrame:
    """``encoded`` with the text its ids stand for. No ids give an empty text; a byte sequence that is no UTF-8 gives
    U+FFFD. Ids outside the vocabulary, null ones and marks without text add nothing."""
    spark: SparkSession = encoded.sparkSession
    shared = spark.sparkContext.broadcast(piece_table(model_path)[2])
    encoded = encoded.drop(out)
    where = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = dict(enumerate(shared.value))
        # few rows at a time, one row's ids as Python numbers at a time
        for b in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            texts = [_spell(spelled, row.values.to_pylist()) if row.is_valid else "" for row in b.column(where)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out])
    return encoded.mapInArrow(run, encoded.withColumn(out, F.lit("")).schema)
