import random

import numpy as np
from helpers import clashing, empty, odd_documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from skirmish.llm import decontamination
from skirmish.llm.decontamination import EDITS, MIN_CHARS, WINDOW, Index, Passages, Q, clean, grams, matches, plain, shared

ITEM = "item_id long, text string"
TEXT = "Each vessel that left the narrow strait carried four sealed crates, whose weight the clerk had noted twice; by evening none of the ledgers could be found anywhere in town."


def edited(text, n, seed):
    rng, out = random.Random(seed), list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = "z"
        elif kind == 1:
            out.insert(at, "q")
        else:
            del out[at]
    return "".join(out)


def test_edits_within_the_budget_are_found():
    index = Passages([(1, TEXT)], Q, WINDOW, EDITS, MIN_CHARS)
    for seed in range(120):
        part = edited(TEXT[20:130], EDITS - 1, seed)
        text = f"{prose(seed, 50)} {part} {prose(seed + 1, 50)}"
        found = index.matches(text)
        assert found, seed
        *_, start, end, edits, _, _ = found[0]
        at = text.index(part)
        assert edits <= EDITS and at - 12 <= start < end <= at + len(part) + 12 and end - start >= WINDOW - 2 * EDITS


def distance(window, text):
    """Least edits of window against any part of text."""
    row, text = np.zeros(len(text) + 1, int), np.array(text)
    steps = np.arange(len(text) + 1)
    for i, c in enumerate(window, 1):
        new = np.r_[i, np.minimum(row[:-1] + (text != c), row[1:] + 1)]
        row = np.minimum.accumulate(new - steps) + steps
    return row.min()


def brute_pairs(texts, items, q=Q, window=WINDOW, edits=EDITS):
    """(text, item) numbers where some window of the item is within its budget of some part of the text."""
    out = set()
    for j, item in enumerate(items):
        c = plain(item)
        if len(c) - 2 < MIN_CHARS:
            continue
        w = min(window, len(c))
        e = max(0, min(edits, w * edits // window, (w + 1) // q - 1))
        for i, text in enumerate(texts):
            if any(distance(c[at : at + w].tolist(), plain(text).tolist()) <= e for at in range(len(c) - w + 1)):
                out.add((i, j))
    return out


def pairs_found(texts, passages, **parameters):
    """(text, item id) from the matches and the shared passages."""
    members = {}
    for name, item in passages.shared():
        members.setdefault(name, set()).add(item)
    out = set()
    for i, text in enumerate(texts):
        for item, name, n, *_ in passages.matches(text, **parameters):
            own = members.get(name, {item})
            assert len(own) == n and item in own
            out |= {(i, m) for m in own}
    return out


def test_pairs_are_brute_force(monkeypatch):
    """Items share beginnings, middles and ends; texts are edited parts of them, blown up by blanks and marks."""
    rng = random.Random(8)
    common = [prose(70 + i, 40)[:n] for i, n in enumerate((150, 96, 60, 210))]
    items = []
    for i in range(14):
        own = f"{prose(200 + i, 30)[: rng.randrange(20, 140)]} q{i}"
        items.append((f"{common[i % 4]} {own}", f"{own} {common[i % 4]}", own, common[i % 4], f"{common[0]} {own} {common[3]}")[i % 5])
    items += [items[0], "tiny item", ""]
    texts = []
    for i in range(26):
        source = items[rng.randrange(len(items) - 2)]
        at = rng.randrange(max(1, len(source) - 60))
        part = edited(source[at : at + rng.randrange(40, 220)], rng.randrange(9), i)
        if i % 4 == 0:
            part = part.replace(" ", " ...\n" * 40).upper()
        texts.append(f"{prose(300 + i, 20)} {part} {prose(400 + i, 20)}"[:3000] if i % 4 else part)
    texts += ["", "?" * 500, common[0], common[1], common[2]]
    passages = Passages(list(enumerate(items)), Q, WINDOW, EDITS, MIN_CHARS)
    want = brute_pairs(texts, items)
    assert len(want) > 40
    for piece, few in ((1 << 20, 64), (300, 64), (1 << 20, 0)):
        monkeypatch.setattr(decontamination, "FEW", few)
        assert pairs_found(texts, passages, piece=piece) == want


def test_wide_blanks_over_a_seam():
    wide = (" " * 1500).join(TEXT.split())
    passages = Passages([(1, TEXT)], Q, WINDOW, EDITS, MIN_CHARS)
    for before in (0, 1 << 19, (1 << 20) - 30_000, (1 << 20) - 300):
        assert passages.matches("x " * (before // 2) + wide), before


def test_an_instruction_in_thousands_of_items(spark):
    sentence = prose(90, 80)[:306]
    rows = [(i, f"{sentence} {prose(5000 + i, 12)} {i}") for i in range(8000)]
    passages = Passages(rows, Q, WINDOW, EDITS, MIN_CHARS)
    found = passages.matches(f"So it said: {sentence} indeed, and more")
    assert len(found) == 1 and found[0][0] == 0 and found[0][2] == 8000
    assert sum(1 for _ in passages.shared()) >= 8000
    # Half of it is no match of any; a whole item is one of its own beside the sentence.
    assert passages.matches(sentence[:70]) == passages.matches(sentence[-70:]) == []
    assert {m[2] for m in passages.matches(rows[77][1])} == {8000}
    assert {m[0] for m in passages.matches(rows[77][1][250:])} >= {77}
    n = np.arange(len(passages.indexes[-1].gram))
    places = list(passages.indexes[-1]._places(n, n, 5000, lambda: None))
    assert sum(len(p) for _, p in places) == len(passages.indexes[-1].item) and sorted(np.concatenate([p for _, p in places]).tolist()) == list(range(len(passages.indexes[-1].item)))
    bench = spark.createDataFrame(rows[:40], ITEM)
    assert shared(bench).where("passage is not null").select("item_id").distinct().count() == 40


def test_repetitive_texts_are_brute_force(monkeypatch):
    """Texts and items that repeat a unit, with edits, cut into many small tiles."""
    rng = random.Random(5)
    units = ["0 ", "ha ", "12 ", "abc def ", "0 0 0 0 1 "]
    items = [u * (260 // len(u)) for u in units] + ["0 " * 30 + prose(1, 12), "no repeats " + prose(2, 20)]
    texts = [edited((units[i % 5] * 400)[: 150 + 40 * (i % 7)], rng.randrange(0, 60), i) for i in range(24)]
    texts += ["0 0 0 0 0 0 x " * 40, "0 0 0 0 0 0 0 0 0 x " * 30, "ha " * 20 + prose(3, 30) + " ha" * 40, "0 " * 400]
    want = brute_pairs(texts, items)
    assert 8 < len(want) < len(texts) * 2
    passages = Passages(list(enumerate(items)), Q, WINDOW, EDITS, MIN_CHARS)
    for places, few in ((1 << 19, 64), (300, 64), (300, 0), (2000, 2)):
        monkeypatch.setattr(decontamination, "PLACES", places)
        monkeypatch.setattr(decontamination, "FEW", few)
        assert pairs_found(texts, passages) == want, places


def test_a_repetitive_text_takes_little_memory_and_time():
    import time
    import tracemalloc

    passages = Passages([(1, "0 " * 150)], Q, WINDOW, EDITS, MIN_CHARS)
    passages.matches("0 " * 1000)
    tracemalloc.start()
    began = time.process_time()
    long = passages.matches("0 " * 500_000)
    near = passages.matches("0 0 0 0 0 0 x " * 5000)
    took, (_, peak) = time.process_time() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert long == passages.matches("0 " * 1000) and near == []
    assert peak < 300 << 20 and took < 30


def test_letters_beyond_the_basic_plane():
    """A mathematical letter is a letter; an emoji parts words as any mark does."""
    assert plain("a\U0001f600b").tolist() == plain("a b").tolist()
    assert plain("\U0001d400\U00010400").tolist() == [0, 0x1D400, 0x10428, 0]
    passages = Passages([(1, TEXT)], Q, WINDOW, EDITS, MIN_CHARS)
    assert passages.matches("\U0001f600".join(TEXT.split()))


def test_alignment_is_the_edit_distance():
    index, item = Index.build([plain(TEXT)], Q, WINDOW, EDITS), plain(TEXT)
    for seed in range(12):
        codes = plain(edited(TEXT[15:140], seed, seed))
        fits = any(distance(item[at : at + WINDOW].tolist(), codes.tolist()) <= EDITS for at in range(len(item) - WINDOW + 1))
        found = [index.align(codes, *r) for r in index.regions(codes)]
        best = min((f[0] for f in found if f), default=None)
        assert not fits or best is not None, seed
        assert best is None or best <= EDITS


@settings(max_examples=100)
@given(st.lists(st.integers(0, 60), min_size=12, max_size=60), st.integers(1, 12))
def test_grams_are_equal_where_text_is(codes, q):
    h, c = grams(np.array(codes, np.uint32), q), codes
    assert len(h) == len(c) - q + 1
    for i in range(len(h)):
        for j in range(i):
            assert c[i : i + q] != c[j : j + q] or h[i] == h[j]


def test_documents(spark):
    passages = [(1, TEXT), (2, None), (3, "too short"), (4, "A rather short item of the benchmark."), (None, TEXT[::-1]), (1, TEXT), (5, "")]
    rows = odd_documents() + [
        (500, f"{prose(1, 40)}\n{TEXT.upper()}", None, None, 0), (501, TEXT[:60], None, None, 0), (502, prose(9, 400), None, None, 0),
        (503, f"x a rather SHORT item -- of the benchmark! {prose(2, 20)}", None, None, 0), (504, TEXT[::-1], None, None, 0),
        (505, prose(3, 250_000) + " " + TEXT, None, None, 0), (None, TEXT, None, None, 0), (None, "fine", None, None, 0),
    ]
    docs, bench = clashing(spark, rows), spark.createDataFrame(passages, ITEM).selectExpr("*", "1 AS doc_id", "2 AS start")
    want = {(500, 1), (503, 4), (504, None), (505, 1), (None, 1)}
    for slice_chars in (1 << 22, 60):
        got = matches(docs, bench, slice_chars=slice_chars).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
        assert {r["n_items"] for r in got} == {1} and shared(bench, slice_chars=slice_chars).count() == 0
    kept = clean(docs, bench)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {500, 503, 504, 505} & set(ids) and {501, 502} <= set(ids) and ids.count(None) == 3 and len(ids) == len(rows) - 5


def test_empty(spark):
    bench = spark.createDataFrame([(1, TEXT)], ITEM)
    assert matches(empty(spark), bench).count() == 0
    docs = spark.createDataFrame(odd_documents(), "doc_id long, text string, lang string, source string, n_chars long")
    assert clean(docs, bench.limit(0)).count() == docs.count()


def test_tables_hold_verbatim_passages(spark):
    folder = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in matches(docs, bench).collect()}
    texts, items = [(r["doc_id"], plain(r["text"] or "").tobytes()) for r in docs.collect()], [(r["item_id"], plain(r["text"]).tobytes()) for r in bench.collect()]
    want = {(d, i) for d, t in texts for i, x in items if x in t}
    assert want and want <= got and len(got - want) <= 2
