"""SimHash, line chunks and sentence spans against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from pagemart.llm import line_dedup, queries, simhash, span_dedup
from pagemart.llm.common import components, read_table

SF = "/root/testdata/sf0.001"


def words(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


# ---- SimHash -----------------------------------------------------------------------------------

def plain_simhash(text):
    """The definition, bit by bit."""
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0d]+", t) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(links, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        up[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_simhash_definition():
    rng = random.Random(0)
    for n in (0, 1, 3, 4, 5, 200):
        t = " ".join(words(rng, n)).replace("w1", "W1\t")
        assert simhash.simhash64(t.encode()) == plain_simhash(t)


@pytest.mark.parametrize("bits", [0, 2, 4])
def test_near_duplicates_equal_brute_force(docs_of, bits):
    rng = random.Random(1)
    base = [words(rng, 300) for _ in range(12)]
    texts = []
    for i in range(160):
        w = list(base[i % 12])
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = "zz"
        texts.append(" ".join(w))
    texts += [None, "", "  ", "one two"]
    ids = list(range(1000, 1000 + len(texts)))
    got = simhash.near_duplicates(docs_of(list(zip(ids, texts))), max_bits=bits).collect()
    fp = {i: plain_simhash(t or "") for i, t in zip(ids, texts)}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{f:016x}" for i, f in fp.items()}
    near = [(a, b) for a in ids for b in ids if a < b and bin(fp[a] ^ fp[b]).count("1") <= bits]
    root = groups(near, ids)
    least = {}
    for i in ids:
        least[root[i]] = min(i, least.get(root[i], i))
    assert {r.doc_id: r.component_id for r in got} == {i: least[root[i]] for i in ids}


def test_links_with_split_buckets_and_pivot_bound(spark):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    fps = {int(centre)}
    while len(fps) < 300:
        x = centre
        for b in rng.integers(0, 64, 6):
            x ^= np.uint64(1) << np.uint64(b)
        fps.add(int(x))
    u = np.array(sorted(fps), dtype=np.uint64)
    d = simhash.pivot_distances(u).astype(int)
    for i in range(0, 300, 7):     # a pair closer than b never differs by more than b in a coordinate
        dist = np.bitwise_count(u ^ u[i])
        assert (np.abs(d - d[i]).max(1) <= dist).all()
    df = simhash._with_pivots(spark.createDataFrame([(int(x),) for x in u.view(np.int64)], "fp long"))
    nodes = u.view(np.int64).tolist()
    near = [(nodes[i], nodes[j]) for i in range(300) for j in range(i) if np.bitwise_count(u[i] ^ u[j]) <= 4]
    want = groups(near, nodes)
    links = [(r.a, r.b) for r in simhash.fingerprint_links(df, 4, bucket_rows=20).collect()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 for a, b in links)
    got = groups(links, nodes)
    assert len(set(got.values())) == len(set(want.values()))
    assert len({(got[n], want[n]) for n in nodes}) == len(set(want.values()))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[i] for i in range(1, 61)}) == 1 and len({got[i] for i in range(100, 160)}) == 1
    assert got[1] != got[100]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- line chunks -------------------------------------------------------------------------------

def chunks_of(text):
    lines = text.split("\n")
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in lines]
    signed = [x - 2**64 if x >> 63 else x for x in h]

    def rolls(i):      # Spark's xxhash64 of two longs: the first seeds the second
        first = xxhash.xxh64(np.int64(signed[i]).tobytes(), seed=42).intdigest()
        return xxhash.xxh64(np.int64(signed[i + 1]).tobytes(), seed=first).intdigest()

    def residue(x):
        return (x - 2**64 if x >> 63 else x) % line_dedup.DIVISOR
    starts = [0] + [i for i in range(1, len(lines) - 1) if residue(rolls(i)) == 0]
    return [(s, lines[s:e]) for s, e in zip(starts, starts[1:] + [len(lines)])]


def test_line_dedup_equals_brute_force(docs_of):
    rng = random.Random(2)
    passage = [" ".join(words(rng, 8)) for _ in range(9)]
    rows = []
    for i in range(60):
        own = [" ".join(words(rng, 6)) for _ in range(rng.randrange(5))]
        rows.append((i, "\n".join(own + (passage if i % 3 else []) + [" ".join(words(rng, 6))])))
    rows += [(90, None), (91, ""), (92, "\n\n\n"), (93, rows[1][1]), (93, rows[1][1]), (None, rows[2][1])]
    got = line_dedup.deduplicate_lines(docs_of(rows)).collect()
    keyed = sorted({(-2**63 if i is None else i, xxhash.xxh64((t or "").encode(), seed=42).intdigest(), t or "") for i, t in rows},
                   key=lambda r: (r[0], r[1] - 2**64 if r[1] >> 63 else r[1]))
    first, want = set(), {}
    for i, _, t in keyed:
        kept = []
        for _, c in chunks_of(t):
            body = "\n".join(c)
            if len(c) > 1 and body.strip(" ") and body in first:
                continue
            if len(c) > 1:
                first.add(body)
            kept += c
        want[i, t] = "\n".join(kept)
    assert len(got) == len(rows)
    originals = {}
    for r in got:
        originals.setdefault(-2**63 if r.doc_id is None else r.doc_id, []).append(r.text)
    for i, t in rows:
        expected = None if t is None else want[-2**63 if i is None else i, t]
        assert expected in originals[-2**63 if i is None else i]
    assert sum(r.n_removed for r in got) > 100


def test_line_dedup_takes_passages_anywhere(docs_of):
    rng = random.Random(8)

    def line(n):
        return " ".join(words(rng, n)) + f" {rng.random()}"
    passages = [[line(30) for _ in range(n)] for n in (2, 2, 2, 3, 3, 5, 5, 10)]
    source = "\n".join(x for p in passages for x in [line(6), *p, line(6)])
    rows, own = [(0, source), (1, source)], {0: source, 1: ""}
    for i in range(2, 42):
        head, tail = [line(6) for _ in range(i % 5)], [line(6) for _ in range(i % 3)]
        rows.append((i, "\n".join([*head, *passages[i % 8], *tail])))
        own[i] = "\n".join(head + tail)
    common = line(6)
    rows += [(i, f"{line(6)}\n{common}\n\n\n\n{line(6)}") for i in (50, 51)]     # one line in common is no passage
    own |= dict(rows[-2:])
    got = line_dedup.deduplicate_lines(docs_of(rows), overlapping=True).collect()
    text = dict(rows)
    for r in got:
        assert r.text == own[r.doc_id], r.doc_id
        assert r.n_lines == text[r.doc_id].count("\n") + 1
    assert sum(r.n_removed for r in got) == source.count("\n") + 1 + sum(len(passages[i % 8]) for i in range(2, 42))


def test_line_dedup_registered_with_windows(spark):
    rows = read_table(spark, SF, "documents").select("doc_id", "text").toPandas().sort_values("doc_id")
    seen, want = set(), {}
    for i, t in zip(rows.doc_id, rows.text):
        lines = (t or "").split("\n")
        solid = [k for k, x in enumerate(lines) if x.strip()]
        gone = set()
        for a, b in zip(solid, solid[1:]):
            body = tuple(lines[a:b + 1])
            if body in seen:
                gone |= set(range(a, b + 1))
            seen.add(body)
        want[i] = gone
    got = {r.doc_id: r for r in queries.op5_lines(spark, SF).collect()}
    assert sum(map(len, want.values())) > 0
    for i, gone in want.items():
        assert got[i].n_removed >= len(gone)


def test_line_dedup_native_plan(spark):
    p = line_dedup.chunk_places(read_table(spark, SF, "documents").selectExpr("doc_id AS k_id", "doc_id AS k_text", "text"), 2)
    assert "Python" not in p._jdf.queryExecution().toString() and "Arrow" not in p._jdf.queryExecution().toString()


# ---- sentence spans ----------------------------------------------------------------------------

def test_span_dedup_equals_brute_force(docs_of):
    rng = random.Random(3)

    def sentence(n):
        return " ".join(words(rng, n)).capitalize() + "."
    passage = " ".join(sentence(rng.randrange(4, 14)) for _ in range(8))
    rows = [(i, " ".join([sentence(9), passage if i % 2 else sentence(30), sentence(5)]) + "\n" + sentence(45)) for i in range(30)]
    rows += [(50, None), (51, ""), (52, " \n "), (53, "short."), (7, rows[7][1])]
    got = {(r.doc_id, r.n_sentences, r.n_removed, r.text) for r in span_dedup.remove_repeated_spans(docs_of(rows)).collect()}
    seen, want = {}, set()
    for i, t in sorted(set(rows), key=lambda r: r[0]):
        spans, found = span_dedup.sentences(t or "")
        gone = set()
        for a, n in span_dedup.runs(found):
            key = tuple(x for w in found[a:a + n] for x in w)
            if seen.setdefault(key, (i, a)) != (i, a):
                gone |= set(range(a, a + n))
        left = (t or "")[:spans[0][0]] + "".join((t or "")[a:b] for k, (a, b) in enumerate(spans) if k not in gone) if spans else t
        want.add((i, len(spans), len(gone), left))
    assert got == want
    assert sum(passage[10:] in (r[3] or "") for r in got) == 1


def test_span_dedup_covers_tails(docs_of):
    rng = random.Random(11)

    def sentence(n):
        return " ".join(words(rng, n)).capitalize() + f" {rng.random()}."
    copy = " ".join(sentence(n) for n in (14, 14, 2))
    passages = [" ".join(sentence(rng.choice((2, 3, 6, 12))) for _ in range(9)) for _ in range(3)]
    rows = [(0, copy), (1, copy)] + [(i, " ".join([sentence(12), passages[i % 3], sentence(3), sentence(15)])) for i in range(2, 17)]
    seen, want = {}, {}
    for i, t in rows:      # all runs, not only the shortest
        found = span_dedup.sentences(t)[1]
        gone = set()
        for a in range(len(found)):
            for b in range(a + span_dedup.MIN_SENTENCES, len(found) + 1):
                key = tuple(x for w in found[a:b] for x in w)
                if len(key) >= span_dedup.MIN_WORDS and seen.setdefault(key, (i, a)) != (i, a):
                    gone |= set(range(a, b))
        want[i] = len(gone)
    got = {r.doc_id: r for r in span_dedup.remove_repeated_spans(docs_of(rows)).collect()}
    assert {i: r.n_removed for i, r in got.items()} == want
    assert got[1].text == "" and got[1].n_removed == 3


def test_span_dedup_without_sentence_ends(docs_of):
    rng = random.Random(21)
    passage = " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(120))
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(n)) + " " + passage + " " + " ".join(f"end{i}x{j}" for j in range(n))) for i, n in enumerate((3, 1, 7, 16, 40))]
    got = {r.doc_id: r for r in span_dedup.remove_repeated_spans(docs_of(rows)).collect()}
    for i, t in rows[1:]:
        left = got[i].text.split()
        assert got[i].n_removed > 5
        assert len([w for w in left if w in set(passage.split())]) <= 2 * span_dedup.MAX_WORDS
    assert got[0].n_removed == 0


def test_sentences_cover_the_text():
    t = "  A b. C d!  E\n\n" + " ".join(["x"] * 45) + "?"
    spans, found = span_dedup.sentences(t)
    assert [a for a, _ in spans][1:] == [b for _, b in spans][:-1] and spans[-1][1] == len(t)
    assert [w for f in found for w in f] == t.split() and max(map(len, found)) <= span_dedup.MAX_WORDS


@pytest.mark.parametrize("op", [simhash.near_duplicates, line_dedup.deduplicate_lines, span_dedup.remove_repeated_spans])
def test_empty_tables(docs_of, op):
    assert op(docs_of([])).count() == 0
