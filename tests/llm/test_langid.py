from collections import Counter

import numpy as np
from helpers import DOCS, clashing, empty, mod5, odd_documents, prose
from pyspark.sql import functions as F

from skirmish.llm.langid import LanguageFilter, digest, identify, learn, ngrams


def test_filter_returns_all_languages_of_an_ngram():
    rng = np.random.default_rng(2)
    grams = rng.integers(0, 2**64, (3, 500), np.uint64)
    profiles = {"a": grams[[0, 1]].ravel(), "b": grams[[1, 2]].ravel(), **{f"l{i}": rng.integers(0, 2**64, 50, np.uint64) for i in range(20)}}
    made = LanguageFilter.build(profiles, list(profiles))
    assert made.slots.dtype == np.uint32
    for row, mask in zip(grams, (0b01, 0b11, 0b10), strict=True):
        assert (made.masks(row) & mask == mask).all()
    strange = made.masks(rng.integers(0, 2**64, 20_000, np.uint64))
    # A full 64-bit-hash filter of this fill denies nearly all strange n-grams for every language.
    assert max((strange >> np.uint32(i) & 1).mean() for i in range(22)) < 0.01


def test_ngrams_stay_within_a_text():
    both = [(n, h) for number, hs in ngrams(["ab cd", "ef"]) for n, h in zip(number.tolist(), hs.tolist(), strict=True)]
    alone = [(n, h) for number, hs in ngrams(["ab cd"]) for n, h in zip(number.tolist(), hs.tolist(), strict=True)]
    assert sorted(x for x in both if x[0] == 0) == sorted(alone)
    assert [h for n, h in both if n == 1] == [h for number, hs in ngrams(["EF!"]) for h in hs.tolist()]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 150 and right / n > 0.95


def test_odd_documents(spark):
    rows = [(1000 + i, prose(i, 80) if i % 2 else "été où naïve garçon déjà façon leçon " * 8, "en" if i % 2 else "fr", "s", 0) for i in range(60)]
    got = digest(clashing(spark, rows + odd_documents())).collect()
    assert len(got) == len(rows) + len(odd_documents())
    for r in got:
        assert r["held_out"] == (mod5(r["doc_id"]) == 0) and 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "fr", "und")
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[0] == by[1] == by[2] == "und" and by[1001] == "en" and by[1000] == "fr" and by[11] == "en"


def test_nothing_to_learn_from(spark):
    assert digest(empty(spark)).count() == 0
    rows = [(i, "some text", None, "s", 0) for i in range(5)]
    assert {tuple(r)[2:] for r in digest(spark.createDataFrame(rows, DOCS)).collect()} == {("und", 0.0)}


def test_long_text_is_read_to_its_end(spark):
    model = LanguageFilter.build({k: np.unique(np.concatenate([h for _, h in ngrams([t])])) for k, t in (("en", prose(1, 500)), ("xx", "zqzq vzvz jwjw kxkx " * 50))}, ["en", "xx"])
    rows = [(1, "the " * 10 + "zqzq vzvz jwjw kxkx " * 90_000, None, None, 0)]
    assert identify(spark.createDataFrame(rows, DOCS), model).first()["lang_pred"] == "xx"
    assert learn(empty(spark), F.lit(True)).languages == []


def gram_hash(gram):
    """The hash of an n-gram, character by character."""
    h, m = ord(gram[0]), 2**64 - 1
    for c in gram[1:]:
        h = (h * 0x100000001B3 + ord(c)) & m
    h = (h + len(gram)) * 0x9E3779B97F4A7C15 & m
    return (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 & m


def grams_of(text):
    plain = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    plain = f" {' '.join(plain.split())} " if plain.strip() else " "
    return [plain[i : i + n] for n in (3, 4) for i in range(len(plain) - n + 1)]


def test_predictions_are_those_of_plain_sets(spark):
    """Profiles by counting in plain Python, n-grams looked up in sets instead of the filter."""
    docs = [r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    train = [r for r in docs if mod5(r["doc_id"]) and r["text"] is not None and r["lang"] is not None]
    order = sorted({r["lang"] for r in train}, key=lambda x: (-sum(r["lang"] == x for r in train), x))
    sets = {}
    for lang in order:
        held = Counter(g for r in train if r["lang"] == lang for g in set(grams_of(r["text"])))
        rows = sorted((-n, (gram_hash(g) + 2**63) % 2**64, g) for g, n in held.items() if n > 1)[:6000]  # ties by the signed hash
        sets[lang] = {g for *_, g in rows}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in digest(spark.createDataFrame(docs)).collect()}
    same, close = [], []
    for r in docs:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert got[r["doc_id"]] == ("und", 0.0)
            continue
        own = grams_of(r["text"])
        counts = [sum(g in sets[lang] for g in own) for lang in order]
        first, second = sorted(counts, reverse=True)[:2]
        same.append(got[r["doc_id"]][0] == order[counts.index(first)] or first == second)
        close.append(abs(got[r["doc_id"]][1] - (first / (first + second) if first else 0)) < 0.05)
    assert len(same) > 800 and np.mean(same) > 0.995 and np.mean(close) > 0.98


def test_more_languages_than_a_word_has_bits(spark):
    rng = np.random.default_rng(3)
    profiles = {f"l{i:03d}": rng.integers(0, 2**64, 40, np.uint64) for i in range(150)}
    made = LanguageFilter.build(profiles, list(profiles))
    assert len(list(made._words())) == 3 and sum(len(w.false) for w in made._words()) == 150
    texts = {f"l{i:03d}": " ".join("".join(chr(0x4E00 + 40 * i + int(c)) for c in rng.integers(0, 12, 5)) for _ in range(60)) for i in range(130)}
    rows = [(1000 * i + j, text, lang, "s", 0) for i, (lang, text) in enumerate(texts.items()) for j in range(1 + i % 3)]
    got = identify(spark.createDataFrame(rows, DOCS), learn(spark.createDataFrame(rows, DOCS), F.lit(True))).collect()
    want = {r[0]: r[2] for r in rows}
    assert all(r["lang_pred"] == want[r["doc_id"]] for r in got)
