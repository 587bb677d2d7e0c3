import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, empty, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from skirmish.llm.packing import CachedTokenizer, pack, pack_histogram, places

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizers(tokenizer):
    cached = CachedTokenizer(PATH, limit=50)
    for _, text, *_ in odd_documents():
        assert np.frombuffer(cached.ids(text), "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def cached():
    return CachedTokenizer(PATH)


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_ids_of_any_text(tokenizer, cached, text):
    assert np.frombuffer(cached.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("mark", [".", "!", ",", "&&&", "_", "'s"])
def test_ids_of_every_letter_before_punctuation(tokenizer, mark):
    """Normalisation takes some letters apart; their marks then belong to the punctuation."""
    cached = CachedTokenizer(PATH)
    texts = [chr(c) + mark for c in range(0x110000) if chr(c).isalpha()]
    real = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [t for t, e in zip(texts, real, strict=True) if np.frombuffer(cached.ids(t), "<u4").tolist() != e.ids] == []


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), min_size=1))
def test_patterns_place_every_piece_once(histogram):
    patterns = pack_histogram(histogram, 64)
    got = Counter()
    for p in patterns:
        assert p.total == sum(n * k for n, k in p.items) <= 64
        for n, k in p.items:
            got[n] += k * p.count
    assert got == Counter(histogram)
    # The places of a length cover its ranks from 0 without a gap.
    table = places(patterns)
    for length in histogram:
        own = table[table[:, 0] == length]
        ends = [*own[1:, 1].tolist(), histogram[length]]
        assert own[0, 1] == 0 and all((end - first) % packs == 0 < end - first for (first, packs), end in zip(own[:, 1:3].tolist(), ends, strict=True))


@pytest.mark.parametrize("seq_len", [256, 8192, 20_000])
def test_round_trip(spark, tokenizer, seq_len):
    rows = odd_documents()
    got = pack(clashing(spark, rows), PATH, seq_len=seq_len, with_ids=True).toPandas()
    want = Counter((r[0], tuple([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in rows)
    assert (got["length"] <= seq_len).all() and (got["offset"] + got["length"] <= seq_len).all()
    for r in got.itertuples():
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert seq["offset"].tolist() == [0, *np.cumsum(seq["length"]).tolist()[:-1]]
    # Every piece of every row is there exactly as often as the row.
    pieces = Counter()
    for (doc, ids), n in want.items():
        for at in range(0, len(ids), seq_len):
            pieces[(doc, at, ids[at : at + seq_len], len(ids))] += n
    assert pieces == Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.start, tuple(r.ids), r.doc_tokens) for r in got.itertuples())


def test_little_padding(spark):
    got = pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), PATH).groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert sum(0 if n & (n - 1) == 0 else 4096 - n for n in got) < 0.02 * 4096 * len(got)


def test_empty(spark):
    assert pack(empty(spark), PATH).count() == 0
