import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, clashing, empty, mod5, odd_documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from skirmish.llm.lm import BUCKETS, LEAST_SHARDS, NONE, SHARD_BYTES, answers, bucket_of, digest, estimates, fit_weights, histogram, pack, pieces, score, sizes_for, unpack, with_parts


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [*[w for w in low.split(" ") if w], None]


def rows():
    return odd_documents() + [(200 + i, prose(i % 23, 40 + i), "en", "s", 0) for i in range(60)]


def test_base_scores_are_brute_force(spark):
    data = rows()
    counts = Counter(t for r in data if mod5(r[0]) != 1 for t in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = sorted(((r[0], mod5(r[0]) == 1, len(t), sum(counts[x] > 0 for x in t), n, sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)) for r in data for t in [tokens(r[1])]), key=repr)
    got = sorted((tuple(r)[:6] for r in digest(clashing(spark, data)).collect()), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])


def test_blocks_and_shards_do_not_matter(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    key = lambda out: sorted((tuple(r) for r in out.collect()), key=lambda r: repr(r[:4]))
    whole, parted = key(score(df, shards=1)), key(score(df, block_bytes=500, shards=7))
    assert [w[:5] for w in whole] == [p[:5] for p in parted]
    for w, p in zip(whole, parted, strict=True):
        assert p[5:] == pytest.approx(w[5:])


class Brute:
    """The model from plain counts: training documents, and those of them that aren't held out."""

    def __init__(self, data):
        self.all = Counter(), Counter()
        self.retained = Counter(), Counter()
        held = []
        for doc, text, *_ in data:
            crc = zlib.crc32(("" if doc is None else str(doc)).encode())
            if crc % 5 == 1:
                continue
            t = tokens(text)
            is_held = crc // 5 % 10 == 0
            for words, pairs in (self.all,) if is_held else (self.all, self.retained):
                words.update(t)
                pairs.update(zip([None, *t[:-1]], t, strict=True))
            if is_held:
                held.append(t)
        words, pairs = self.retained
        n, v = sum(words.values()), len(words)
        seen = [(pairs[c, w], words[c], words[w]) for t in held for c, w in zip([None, *t[:-1]], t, strict=True)]
        p2, c, p1 = (np.array(x, np.int64) for x in zip(*seen, strict=True))
        self.weights = fit_weights(histogram(*estimates(p1, c, p2, n, v), bucket_of(c)))

    def probability(self, context, word):
        words, pairs = self.all
        n, v, c = sum(words.values()), len(words), words[context]
        bucket = 0 if c == 0 else min(1 + int(math.log2(c)), BUCKETS - 1)
        a, b, u = self.weights[bucket]
        return a * (pairs[context, word] / c if c else 0) + b * words[word] / n + u / (v + 1)


def test_scores_are_brute_force(spark):
    data = rows() + [(3000 + i, prose(i % 7, 60), None, None, 0) for i in range(200)]
    model = Brute(data)
    want = sorted(((repr(r[0]), sum(math.log10(model.probability(c, w)) for c, w in zip([None, *t[:-1]], t, strict=True))) for r in data for t in [tokens(r[1])]))
    for parameters in ({}, {"block_bytes": 700, "shards": 5}, {"block_bytes": 700, "shard_bytes": 100}, {"block_bytes": 700, "shards": 30, "direct": 4}):
        got = sorted((repr(r["doc_id"]), r["score"]) for r in score(clashing(spark, data).coalesce(2), **parameters).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[1] for g in got] == pytest.approx([w[1] for w in want])
    # Over all words and one unseen the probabilities sum to one, whatever word went before.
    vocabulary = list(model.all[0])
    for context in vocabulary[:60]:
        assert sum(model.probability(context, w) for w in [*vocabulary, "unseen"]) == pytest.approx(1)


def test_rows_of_the_exchange_grow_as_the_input(spark):
    """Shards and batches follow from the input, as in score(): four times the text makes at most 4.5 times the rows."""
    made = []
    for n in (150, 600):
        docs = with_parts(spark.createDataFrame([(i, " ".join(f"w{(i * 200 + k) * 7919 % 9973}" for k in range(200)), None, None, 0) for i in range(n)], DOCS).coalesce(1))
        shards, blocks = sizes_for(docs.selectExpr("sum(octet_length(text))").first()[0], 1 << 10)
        assert shards > LEAST_SHARDS
        made.append(answers(docs, shards, 1 << 11, blocks).count())
    assert made[1] <= 4.5 * made[0]


def test_rows_in_two_steps(spark):
    """No step has a row for every batch and shard, and the answers are the same."""
    docs = with_parts(spark.createDataFrame([(i, " ".join(f"w{(i * 200 + k) * 7919 % 9973}" for k in range(200)), None, None, 0) for i in range(600)], DOCS).coalesce(1))
    once, twice = (answers(docs, 400, 1 << 12, 4, direct, 60).where("batch >= 0").toPandas() for direct in (400, 20))
    assert len(once) > 8 * len(twice)

    def whole(table):
        out = {}
        for batch, own in table.sort_values("shard").groupby("batch"):
            sizes = np.array([list(n) for n in own["sizes"]])
            held = [np.split(unpack(t, n.sum()), np.cumsum(n)[:-1]) for t, n in zip(own["total"], sizes, strict=True)]
            out[batch] = [np.concatenate([h[i] for h in held]).tolist() for i in range(sizes.shape[1])], np.array([list(c) for c in own["checks"]]).sum(0).tolist()
        return out

    assert whole(once) == whole(twice)


def test_sizes_are_bounded():
    for gb in (0.01, 0.5, 2, 30, 1000, 100_000):
        total = int(gb * 2**30)
        shards, blocks = sizes_for(total)
        assert shards >= LEAST_SHARDS and total / shards <= 3 * SHARD_BYTES and blocks <= 12
    rows = lambda gb: sizes_for(int(gb * 2**30))[0] * gb / sizes_for(int(gb * 2**30))[1]
    assert all(rows(4 * gb) <= 4.5 * rows(gb) for gb in (0.5, 1))


def test_model_beats_base_on_held_out_text(spark):
    got = digest(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").toPandas()
    assert got["score"].sum() > got["base_score"].sum()


def test_empty(spark):
    assert digest(empty(spark)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=200), st.integers(1, 30))
def test_pieces_lose_no_word(text, size):
    parts = list(pieces(text, size))
    assert b"".join(p for p, *_ in parts) == text and [last for *_, last in parts] == [False] * (len(parts) - 1) + [True]
    assert [w for p, *_ in parts for w in p.split()] == text.split()
    for (before, *_), (_, prev, _) in zip(parts, parts[1:], strict=False):
        assert not before.split() or prev == before.split()[-1]


@given(st.lists(st.integers(0, 2**40)))
def test_counts_pack(numbers):
    assert unpack(pack(np.array(numbers, np.int64)), len(numbers)).tolist() == numbers


def test_weights_follow_held_out_counts():
    import pandas as pd

    held = pd.DataFrame({"bucket": [5, 5, 2, 2, 0], "two": [40, NONE, NONE, NONE, NONE], "one": [4, 4, 20, 20, 8], "n": [5000, 100, 3000, 10, 500]})
    w = fit_weights(held)
    assert w.shape == (BUCKETS, 3) and w.sum(1) == pytest.approx(1) and w[0, 0] == 0 and (w[1:] > 0).all()
    assert w[5, 0] > 0.9 and w[2, 1] > 0.8
    assert fit_weights(held.iloc[:0]).sum(1) == pytest.approx(1)
