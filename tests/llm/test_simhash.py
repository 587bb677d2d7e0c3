from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from helpers import clashing, empty, odd_documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skirmish.llm import simhash
from skirmish.llm.simhash import block_masks, choose_blocks, digest, embedding, links, manhattan, near_duplicates, representatives, similar_documents

U64 = st.integers(0, 2**64 - 1)


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in combinations(list(nodes), 2):
        if root(a) != root(b) and linked(a, b):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {n: root(n) for n in nodes}


@given(U64, U64)
def test_manhattan_is_a_lower_bound(x, y):
    a, b = np.array([x], np.uint64), np.array([y], np.uint64)
    counts = lambda v: [bin(v >> (2 * s) & 3).count("1") for s in range(32)]
    want = sum(abs(p - q) for p, q in zip(counts(x), counts(y), strict=True))
    assert manhattan(embedding(a), embedding(b))[0] == want <= bin(x ^ y).count("1")


@settings(max_examples=100)
@given(U64, st.sets(st.integers(0, 63), max_size=4), st.integers(5, 10))
def test_no_link_is_out_of_reach(x, flips, n_blocks):
    y = x
    for b in flips:
        y ^= 1 << b
    p, q = (int(embedding(np.array([v], np.uint64))[0]) for v in (x, y))
    assert any(p & m == q & m for m in block_masks(n_blocks, 4))


def test_blocks_grow_with_the_table():
    chosen = [choose_blocks(n, 4) for n in (10, 10**5, 10**9)]
    assert chosen == sorted(chosen) and chosen[0] < chosen[-1]


@pytest.mark.parametrize("cell_limit", [8192, 6])
def test_components_are_brute_force(spark, cell_limit):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**64, 12, np.uint64)
    fps = {int(c) for c in centres}
    for c in centres[:6]:  # chains and balls of fingerprints
        now = int(c)
        for _ in range(25):
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                now ^= 1 << int(b)
            fps.add(now)
            now = int(c) if rng.random() < 0.5 else now
    signed = sorted(f - 2**64 if f >> 63 else f for f in fps)
    want = classes(signed, lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 4)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = links(df, cell_limit=cell_limit).collect()
    assert all(bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") <= 4 for r in found)
    edges = {frozenset((r["a"], r["b"])) for r in found}
    assert classes(signed, lambda a, b: frozenset((a, b)) in edges) == want
    got = {r["node"]: r["component"] for r in simhash.components(links(df, cell_limit=cell_limit)).collect()}
    assert {n: got.get(n, n) for n in signed} == want


def test_documents(spark):
    rows = odd_documents() + [(300 + i, prose(7, 200) + f" tail{i // 3}", None, None, 0) for i in range(9)]
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in digest(clashing(spark, rows)).collect()), key=repr)
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    comp = classes({f for _, f in fps}, lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for doc, f in fps:
        if doc is not None:
            least[comp[f]] = min(doc, least.get(comp[f], doc))
    assert got == sorted(((d, f"{f:016x}", least.get(comp[f])) for d, f in fps), key=repr)


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (x.split() for x in (a, b))]
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1]))


@pytest.mark.parametrize("cell_limit", [8192, 8])
def test_similar_documents(spark, cell_limit):
    texts = {}
    for g in range(12):
        words = prose(50 + g, 300).split()
        for v in range(5):  # from equal to well under the limit
            texts[10 * g + v] = " ".join(f"w{g}{v}" if i % 60 < v and i < 60 * v else w for i, w in enumerate(words))
    texts |= {900: "", 901: " \n", 902: "one two", 903: "one two"}
    pairs = {(a, b): jaccard(texts[a], texts[b]) for a, b in combinations(texts, 2)}
    want = classes(texts, lambda a, b: pairs.get((a, b), pairs.get((b, a), 0)) >= 0.8 or not (texts[a].split() or texts[b].split()))
    rows = [(d, t, None, None, 0) for d, t in texts.items()]
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(clashing(spark, rows), cell_limit=cell_limit).collect()}
    assert len(set(want.values())) < len(texts) and sum(got[d] != want[d] for d in texts) <= 0.05 * len(texts)
    assert all(want[d] == want[got[d]] for d in texts), "nothing is merged that isn't similar"


@pytest.mark.parametrize("cell_limit", [8192, 70])
def test_copies_in_a_dense_region(spark, cell_limit):
    template, texts = prose(77, 400).split(), {}
    for g in range(300):  # two copies each; texts of different groups are just not similar enough
        words = [f"g{g}" if i % 40 == 0 else w for i, w in enumerate(template)]
        for v in range(2):
            texts[10 * g + v] = " ".join(f"v{v}" if i == 20 * v + 5 else w for i, w in enumerate(words))
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in ((d, t.split()) for d, t in texts.items())}
    want = classes(texts, lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    assert len(set(want.values())) == 300
    rows = [(d, t, None, None, 0) for d, t in texts.items()]
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(clashing(spark, rows), cell_limit=cell_limit).collect()}
    assert sum(got[d] != want[d] for d in texts) <= 0.01 * len(texts)


def test_representatives_keep_whole_rows(spark):
    rows = odd_documents()
    df = clashing(spark, rows)
    kept = representatives(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    # 0, 1 and 2 are blank, 5 and 6 repeat 4 (6 in capitals), 7 has a repeated row; those without an id repeat 7 and 0.
    assert ids == sorted([0, 3, 4, 7, 8, 9, 10, 11, 12, 13, 14], key=repr)


def test_rows_of_one_id_and_of_none(spark):
    """Different texts under one id are documents of their own; rows without an id take part."""
    a, b, c = prose(21, 80), prose(22, 80), prose(23, 80)
    rows = [(5, a, "x", None, 0), (5, b, "x", None, 0), (6, b + " end", None, None, 0), (None, c, "y", None, 1), (None, c + " end", "z", None, 2), (None, a, None, None, 0), (None, None, None, None, 0)]
    df = clashing(spark, rows).withColumns({n: F.lit(0) for n in ("t1", "t2", "d", "set1", "first_row", "component_id")})
    kept = representatives(df)
    got = sorted(((r["doc_id"], (r["text"] or "").removesuffix(" end")) for r in kept.collect()), key=repr)
    assert kept.columns == df.columns and got == sorted([(5, a), (5, b), (None, c), (None, "")], key=repr)


def test_tables_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets, holders, pairs = {}, {}, Counter()
    for r in docs.collect():
        words = (r["text"] or "").encode().lower().split()
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    for d, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(d)
    for own in holders.values():
        pairs.update(combinations(sorted(own), 2))
    true = {p for p, n in pairs.items() if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)}
    blank = [d for d, own in sets.items() if not own]
    true |= set(combinations(sorted(blank), 2))
    edges, parent = sorted(true), {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for x, y in edges:
        x, y = sorted((root(x), root(y)))
        parent[y] = x
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(docs).collect()}
    assert len(true) > 50 and np.mean([got[x] == got[y] for x, y in true]) >= 0.95
    assert all(root(d) == root(c) for d, c in got.items()), "nothing is merged that isn't similar"


@pytest.mark.parametrize("n", [64, 600, 20_000])
def test_large_cells_lose_no_pair(n):
    """One cell of families of two around one template; rows in a family differ by up to 6 bits, families by about 50. Every
    pair within the distance is handed on, or both its rows are marked to be compared with their sets."""
    rng = np.random.default_rng(n)
    bits = (rng.random((n // 2, 128)) < 0.25) ^ (rng.random(128) < 0.5)
    second = bits.copy()
    for row in second:
        row[rng.choice(128, rng.integers(0, 7), replace=False)] ^= True
    both = np.packbits(np.concatenate([bits, second]), axis=1).view(np.uint64)
    order, results = rng.permutation(n), []
    for at in (order, np.arange(n)):  # the order of rows changes nothing
        l, r, core = simhash.close_in_cells(np.zeros(n, np.int64), np.arange(n)[at], both[at, 0].copy(), both[at, 1].copy(), 31)
        found = {(min(x, y), max(x, y)) for x, y in zip(l.tolist(), r.tolist(), strict=True)}
        marked = set(np.arange(n)[at][core].tolist())
        assert all((i, i + n // 2) in found or {i, i + n // 2} <= marked for i in range(n // 2))
        results.append((found, marked))
    assert results[0] == results[1]


def test_empty(spark):
    assert near_duplicates(empty(spark)).count() == representatives(empty(spark)).count() == 0
