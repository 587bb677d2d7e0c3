import numpy as np
import pandas as pd
from helpers import clashing, empty, mod5, odd_documents, prose
from pyspark.sql import functions as F

from skirmish.llm import line_dedup
from skirmish.llm.toxicity import CHUNK, DIM, FILTERS, STEM_BITS, WIDTHS, ConvNet, best_threshold, digest, fit, learn, loss_and_gradients, scorer, thresholds, without_toxic, word_ids

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = digest(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    bad, good = got[got["toxic"] == 1]["score"].to_numpy(), got[got["toxic"] == 0]["score"].to_numpy()
    assert (bad[:, None] > good).mean() > 0.95
    assert (bad >= 0.5).mean() > 0.75 and (good >= 0.5).mean() < 0.03


def planted():
    rows = [(i, prose(i, 60) + (" grubbel " if i % 4 == 0 else " ") + prose(i + 1, 20), "en", "s", 0) for i in range(400)]
    return rows, [(i, 1, int(i % 4 == 0)) for i in range(400)]


def test_odd_documents_and_labels(spark, monkeypatch):
    rows, marks = planted()
    odd = [(5000 + (r[0] or 0), *r[1:]) for r in odd_documents()]
    marks += [(1, 0, None), (None, 0, 1), (3, 0, 0), (3, 0, 0), (999_999, 1, 1)]
    docs, labels = clashing(spark, rows + odd), spark.createDataFrame(marks, LABELS)
    got = digest(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    net, trained = learn(docs, labels, F.lit(True), sample_words=4000)
    assert isinstance(net, ConvNet) and 20 < trained.count() < 60
    for r in got:
        assert r["held_out"] == (mod5(r["doc_id"]) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert np.mean([by[i] == (i % 4 == 0) for i in range(400)]) > 0.97
    model, points = fit(docs, labels, F.lit(True))
    assert points.count() == docs.count()
    kept = without_toxic(docs, points, model)
    assert kept.columns == docs.columns and 270 < kept.where("doc_id < 400").count() < 330
    # Sent along, by the filter, by a join, and by a filter that takes every kept text for a rejected one, the same rows stay.
    want = sorted(map(repr, kept.collect()))
    for filter_bytes in (1 << 20, 0):
        assert sorted(map(repr, without_toxic(docs, points, model, broadcast_rows=0, filter_bytes=filter_bytes).collect())) == want
    wrong = line_dedup.CuckooFilter(1)
    wrong.mask, wrong.table = 1, np.tile(np.arange(1, 1 << 16, dtype=np.uint16), (2, 1))
    monkeypatch.setattr(line_dedup, "small_filters", lambda *_: {0: wrong})
    for exceptions in (100_000, 5):
        assert sorted(map(repr, without_toxic(docs, points, model, broadcast_rows=0, exceptions=exceptions).collect())) == want


def test_labels_of_one_kind_or_none(spark):
    docs = spark.createDataFrame([(i, "a text", None, None, 0) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long")
    for marks, want in (([(i, 1, 0) for i in range(6)], 0.0), ([(i, 1, 1) for i in range(6)], 1.0), ([], 0.0)):
        assert {r["score"] for r in digest(docs, spark.createDataFrame(marks, LABELS)).collect()} == {want}
    assert digest(empty(spark), spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 0


def test_pooling_reads_whole_texts():
    net, ids = ConvNet.fresh(1), word_ids(prose(3, 2 * CHUNK + 77))
    whole = np.concatenate([r.max(0) for r in net.responses(net.embed(ids))])
    assert np.allclose(net.pooled(ids), np.maximum(whole + net.bias, 0), atol=1e-5)
    assert np.isfinite(net.logits([word_ids(None), word_ids("one")])).all()


def test_forward_pass_is_brute_force():
    net = ConvNet.fresh(4)
    net.bias += 0.05
    for text in (None, "one", "two words", prose(5, 30)):
        ids = word_ids(text)
        x = [[float(net.words[i >> STEM_BITS][d] + net.stems[i & (2**STEM_BITS - 1)][d]) for d in range(DIM)] for i in ids.tolist()]
        total = net.offset
        for n, w in enumerate(WIDTHS):
            padded = x + [[0.0] * DIM] * max(0, w - len(x))
            for f in range(FILTERS):
                said = [sum(padded[at + j][d] * float(net.filters[w][j * DIM + d, f]) for j in range(w) for d in range(DIM)) for at in range(len(padded) - w + 1)]
                total += max(0.0, max(said) + float(net.bias[n * FILTERS + f])) * float(net.weights[n * FILTERS + f])
        assert abs(net.logits([ids])[0] - total) < 1e-4


def test_gradients_are_finite_differences():
    net, rng = ConvNet.fresh(6), np.random.default_rng(1)
    for name in ("words", "stems", "bias", "weights"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters = {w: f.astype(np.float64) for w, f in net.filters.items()}
    texts, labels, weight = [word_ids(prose(i, 3 + 5 * i)) for i in range(4)], np.array([1, 0, 0, 1]), np.array([2.0, 0.5, 1.0, 1.0])
    drop = (rng.random((4, FILTERS * len(WIDTHS))) > 0.2) / 0.8
    loss = lambda: loss_and_gradients(net, texts, labels, weight, drop)[0]
    _, dense, hit, grad = loss_and_gradients(net, texts, labels, weight, drop)
    word = np.zeros(net.words.shape)
    np.add.at(word, hit >> STEM_BITS, grad)
    checked = [(net.weights, dense["weights"]), (net.bias, dense["bias"]), *[(net.filters[w], dense[f"filter{w}"]) for w in WIDTHS], (net.words, word)]
    for value, got in checked:
        places = np.argwhere(np.abs(got) > 1e-3)
        assert len(places)
        for at in map(tuple, places[rng.permutation(len(places))[:12]]):
            was = value[at]
            value[at] = was + 1e-4
            up = loss()
            value[at] = was - 1e-4
            down = loss()
            value[at] = was
            assert abs((up - down) / 2e-4 - got[at]) < 0.02 * abs(got[at]) + 2e-4


def test_scores_are_the_networks(spark):
    """Scores and predictions of the tables against the network applied in this process, and thresholds to all labels."""
    rows, marks = planted()
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(marks, LABELS)
    model, points = fit(docs, labels, F.lit(True))
    lang, logit = scorer(*model.network.value)([r[1] for r in rows])
    got = {r["doc_id"]: r for r in points.collect()}
    assert all(got[r[0]]["lang"] == n and abs(got[r[0]]["logit"] - z) < 1e-4 for r, n, z in zip(rows, lang.tolist(), logit.tolist(), strict=True))
    moved = np.array([model.thresholds.get(n, model.thresholds[-1]) for n in lang.tolist()])
    scored = {r["doc_id"]: r["s"] for r in points.withColumn("s", model.score()).collect()}
    assert np.allclose([scored[r[0]] for r in rows], 1 / (1 + np.exp(moved - logit)), atol=1e-4)


def test_threshold():
    one = lambda toxic: (np.array(toxic, float), 1 - np.array(toxic, float))
    assert 1 < best_threshold(np.array([3.0, 2.0, 1.0, 0.0]), *one([1, 1, 0, 0])) < 2
    assert best_threshold(np.array([1.0, 0.0]), np.array([1.0, 0.0]), np.array([1.0, 1.0])) == 0.5
    assert 1 < best_threshold(np.array([3.0, 2.0, 1.0, 0.0]), *one([0, 0, 0, 1]), most=0.5) < 3
    rows = [(0, 0, 0, 100), (0, 1, 128, 50), (1, 0, 256, 900), (1, 1, 384, 60), (2, 1, 640, 5)]
    got = thresholds(pd.DataFrame(rows, columns=["lang", "toxic", "bin", "n"]))
    assert set(got) == {-1, 0, 1} and 0 < got[0] < 2 and 4 < got[1] < 6


def test_language_that_holds_most_of_the_toxic(spark):
    """5 % of all rows are toxic, 30 % in one language."""
    rows, marks = [], []
    for i in range(4200):
        other, bad = i % 6 == 0, i % 18 == 0 or i % 180 == 6
        text = prose(i, 14)[:: -1 if other else 1] + (" grubbel " if bad else " ") + prose(i + 1, 4)[:: -1 if other else 1]
        rows.append((i, text, "xx" if other else "en", "s", 0))
        marks.append((i, 1, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(marks, LABELS)
    got = {r["doc_id"]: r["predicted"] for r in digest(docs, labels).collect()}
    found = [got[i] for i, _, bad in marks if bad]
    assert 0.04 < len(found) / len(rows) < 0.07 and np.mean(found) > 0.9
    assert np.mean([got[i] for i, _, bad in marks if not bad]) < 0.02
