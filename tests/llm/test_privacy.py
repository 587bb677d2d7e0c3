import re
import time
from hashlib import sha256

import numpy as np
import pytest
from helpers import DOCS, clashing, empty, odd_documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from skirmish.llm import privacy
from skirmish.llm.privacy import BASE, KINDS, Trees, base_matches, calibrated, candidates, digits_of, find, fit, luhn, redact, redacted, scan

PATTERNS = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def passes(kind, said):
    digits = re.sub("[^0-9]", "", said)
    weights = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
    return [True, all(int(p) <= 255 for p in said.split(".")) if kind == 1 else None, 14 <= len(digits) <= 19 and sum(w // 10 + w % 10 for w in weights) % 10 == 0, 10 <= len(digits) <= 15][kind]


def brute(text):
    """(start, kind, end) of the base spans, by the patterns as they stand."""
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text or "") if passes(k, m[0]))


def base_of(text):
    return sorted((a, k, b) for k, a, b, ok in base_matches(text) if ok)


def said(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


CARD = "4539 1488 0343 6467"
TEXTS = [f"a.b+c%d@mail-1.example.co.uk, {CARD} and +49 (30) 1234-5678.", "x@y a@b.c.d_e@f.g @h.i j@k..l m@n.o. p@-.q", "1.2.3.4.5.6.7.8.9 300.1.1.1 1.2.3 0001.2.3.0255 1..2.3.4.5 .9.8.7.6.", "4539148803436467 4539-1488-0343-6467 4539--1488-0343-6467 5 4539148803436468 45391488034364671234567", "+1 (017) 555-7713 +123 +1234567890123456 ++12345678901 +1----- 5 +49 30 1234567.", "é😀 +4930123456789\n1.1.1.1", "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "@", "a@b", ""]


def test_base_spans_are_brute_force(spark):
    rows = [(i, t, None, None, 0) for i, t in enumerate(TEXTS)] + [(100 + i, *r[1:]) for i, r in enumerate(odd_documents())]
    got = {r["doc_id"]: r for r in find(clashing(spark, rows).repartition(3)).collect()}
    assert len(got) == len(rows)
    for doc, text, *_ in rows:
        spans, r = brute(text), got[doc]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[1] == i for s in spans) for i in range(4)], text
        assert r["base_sha256"] == sha256(said(spans).encode()).hexdigest() and r["spans"] == said(spans) and r["n_added"] == 0, text


@settings(max_examples=400)
@given(st.text(alphabet="0123456789. -+()@aZ_%\n", max_size=60))
def test_base_patterns(text):
    assert base_of(text) == brute(text)
    # Proposals lie in the text, touch no base span and name none twice.
    records = candidates(text)
    base = [(s, e) for s, _, e in base_of(text)]
    more = [(r["start"], r["end"], r["kind"]) for r in records if r["label"] == privacy.PROPOSED]
    assert len(set(more)) == len(more) and all(0 <= a < b <= len(text) and not any(x < b and a < y for x, y in base) for a, b, _ in more)


@pytest.mark.parametrize("piece", ["x", "1", "1.", "1 ", "@", "a@", "+1", "1-", "(at)", "1(", "+1 ", "a.", "[.]1", "1  ", "a@b.c "])
def test_time_grows_as_the_length(piece):
    took = []
    for n in (20_000, 80_000):
        began = time.process_time()
        candidates((piece * n)[:n])
        took.append(time.process_time() - began)
    assert took[1] < 9 * took[0] + 0.3


def test_luhn():
    assert luhn("4539148803436467") and not luhn("4539148803436468") and digits_of("٣4a5") == "45"


def test_trees_learn_what_one_split_cannot():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (4000, 6)).astype(np.uint8)
    y = ((x[:, 1] > 100) ^ (x[:, 4] > 180)).astype(float)
    trees = Trees.train(x[:3000], y[:3000])
    assert (((trees.logits(x[3000:]) > 0) == y[3000:]).mean()) > 0.95
    flat = Trees.train(x[:50], np.ones(50), rounds=3)
    assert (flat.logits(x) > 5).all()


def test_leaves_are_newton_steps():
    """A tree of one split is found by trying all splits."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (200, 3)).astype(np.uint8)
    y = (rng.random(200) < 0.2 + 0.6 * (x[:, 2] > 2)).astype(float)
    trees = Trees.train(x, y, rounds=1, depth=1, rate=1.0)
    p = y.mean()
    g, h = p - y, np.full(200, p * (1 - p))
    score = lambda own: g[own].sum() ** 2 / (h[own].sum() + 1)
    best = max(((f, c) for f in range(3) for c in range(5)), key=lambda s: score(x[:, s[0]] <= s[1]) + score(x[:, s[0]] > s[1]))
    assert (trees.feature[0][0], trees.cut[0][0]) == best
    left = x[:, best[0]] <= best[1]
    assert np.allclose(trees.leaf[0], [-g[own].sum() / (h[own].sum() + 1) for own in (left, ~left)])


def test_threshold():
    base, others = np.zeros(privacy.BINS + 1, int), np.zeros(privacy.BINS + 1, int)
    base[[850, 900, 950]], others[[100, 899]] = [5, 50, 50], [500, 20]
    assert calibrated(base, others, 0.9) == 0.9 and calibrated(base, others, 0.83) == 0.85 and calibrated(others * 0, others, 0.5) is None


def planted(n):
    """Phones after a word that says so, with and without a plus, and numbers of orders of the same length without."""
    rows, new, clean = [], {}, set()
    for i in range(n):
        number = f"{200 + i % 700} {100 + i * 7 % 900} {1000 + i * 31 % 9000}"
        before, after = prose(i, 8), prose(i + 1, 8)
        if i % 4 == 3:
            rows.append((i, f"{before} order no {10**9 + i * 7919} {after}", None, None, 0))
            clean.add(i)
        elif i % 40 == 1:
            rows.append((i, f"{before} call 1 {number} {after}", None, None, 0))
            new[i] = (len(before) + 6, len(before) + 8 + len(number))
        else:
            rows.append((i, f"{before} call +1 {number} {after}", None, None, 0))
    return rows, new, clean


def test_added_spans(spark):
    """Numbers written as base ones but for the plus are found, order numbers and rejected matches stay."""
    rows, new, clean = planted(2400)
    rows += [(10_000 + i, f"{prose(i, 5)} 4539 1488 0343 646{i % 10} {prose(i, 3)}", None, None, 0) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    model = fit(scan(docs), least_precision=0.9)
    got = {r["doc_id"]: r for r in find(docs, least_precision=0.9).collect()}
    found = [i for i, (a, b) in new.items() if got[i]["spans"] == f"phone:{a}:{b}" and got[i]["n_added"] == 1]
    assert len(found) >= 0.9 * len(new) and not any(got[i]["spans"] for i in clean)
    assert all(got[10_000 + i]["n_added"] == 0 for i in range(60))
    for i, text, *_ in rows:
        assert got[i]["base_sha256"] == sha256(said(brute(text)).encode()).hexdigest()
        assert set(said(brute(text)).split(",")) - {""} <= set(got[i]["spans"].split(","))
    texts = {r["doc_id"]: r["text"] for r in redact(docs, model).collect()}
    assert all(re.fullmatch(r"[a-z ]+ call \[phone\] [a-z ]+", texts[i]) for i in found) and all(texts[i] == rows[i][1] for i in clean)


def test_overlapping_proposals_and_redaction():
    records = candidates("tel 415 555 0132 or 415 555 0199, a@b.c")
    model = privacy.Model(np.zeros((4, 2, 1 << privacy.WORD_BITS)), {}, {privacy.PHONE: 0.5})
    scores = np.where(records["end"] - records["start"] == 12, 0.9, 0.6)
    spans = model.select(records, scores)
    assert [(r["start"], r["end"], r["label"]) for r in spans] == [(4, 16, -1), (20, 32, -1), (34, 39, BASE)]
    assert redacted("tel 415 555 0132 or 415 555 0199, a@b.c", spans) == "tel [phone] or [phone], [email]"


def test_same_rows_whatever_the_partitions(spark):
    rows, *_ = planted(800)
    docs = spark.createDataFrame(rows + [(None, None, None, None, 0), rows[5], rows[5]], DOCS)
    assert sorted(map(repr, find(docs.repartition(1)).collect())) == sorted(map(repr, find(docs.repartition(7)).collect()))


def test_empty(spark):
    assert find(empty(spark)).count() == 0
    assert redact(empty(spark), fit(scan(empty(spark)))).count() == 0
