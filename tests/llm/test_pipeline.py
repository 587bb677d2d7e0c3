import zlib
from itertools import combinations

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from helpers import DOCS, clashing, odd_documents, prose
from test_decontamination import brute_pairs
from test_line_dedup import key
from tokenizers import Tokenizer

from skirmish.llm import toxicity
from skirmish.llm.common import crc_mod5

FOLDER = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, n = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        n.append(docs.count())
    assert n == sorted(n, reverse=True) and n[1] == n[2] and n[-1] > 0.3 * n[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    whole = corpus_pipeline.run(spark, FOLDER)
    key = lambda df: sorted(map(tuple, df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()))
    assert key(packed) == key(whole) and {r[0] for r in key(whole)} == {r["doc_id"] for r in docs.select("doc_id").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1000 + i, prose(100 + i, 90), "en", "s", 0) for i in range(20)] + [(2000, prose(100, 90), "en", "s", 0)]
    return clashing(spark, odd_documents() + rows)


def test_odd_documents_pass_every_stage(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == odd.columns
    ids = {r["doc_id"] for r in docs.collect()}
    assert {1000 + i for i in range(20)} <= ids and 2000 not in ids
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= len(ids)


def test_line_stage_changes_texts_only(spark, odd):
    before, out = odd.collect(), corpus_pipeline.drop_repeated_lines(spark, odd, FOLDER)
    texts, want = dict(enumerate(cut_lines([(r["doc_id"], r["text"]) for r in before]))), []
    for i, r in enumerate(before):
        row = r.asDict() | {"text": texts[i][1]}
        if row["text"] != r["text"]:
            row["n_chars"] = len(row["text"])
        want.append(repr(tuple(row[c] for c in odd.columns)))
    assert sorted(want) == sorted(repr(tuple(r)) for r in out.collect()) and out.dtypes == odd.dtypes
    assert sum(texts[i][1] != r["text"] for i, r in enumerate(before)) > 4


def cut_lines(rows):
    """(id, text) without lines that three documents hold, but in the largest."""
    held = {}
    for doc, text in rows:
        for x in (text or "").split("\n"):
            if doc is not None and len(key(x)) >= 20:
                held.setdefault(key(x), set()).add(doc)
    gone = lambda doc, x: len(held.get(key(x), ())) >= 3 and max(held[key(x)]) != doc
    return [(doc, None if text is None else "\n".join(x for x in text.split("\n") if not gone(doc, x))) for doc, text in rows]


ITEMS = ["The archivist sealed the copper box at dusk and hid the key beneath a loose tile, where it lay for forty winters unseen.", "Nine painted masks hung along the corridor wall; only the seventh, they said, had ever been worn by a living king of the isles."]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """200 documents, some toxic, with repeated lines, near copies, benchmark passages and odd rows."""
    folder, rows, labels = tmp_path_factory.mktemp("planted"), [], []
    line = "Subscribe to our newsletter for more stories like this one."
    for i in range(200):
        text = prose(3000 + i, 50 + i % 23)
        if i % 5 == 1:
            text += " grubbel mirf"
        if i % 9 == 2:
            text = f"{line}\n{text}\n  {line.upper()}"
        if i % 20 == 3:
            text += "\n" + ITEMS[i // 20 % 2].replace("e", "E", 3).replace("the", "teh", i // 40)
        if i % 10 == 7:
            text = rows[i - 4][1] + " and a tail"
        rows.append((i, text, "en" if i % 3 else None, f"s{i % 4}", len(text)))
        labels.append((i, 1, int(i % 5 == 1)))
    rows += [(900, None, None, None, None), (901, "", None, None, 0), (None, rows[0][1], None, None, 1), (902, rows[8][1], "en", "s", 2), (902, rows[8][1], "en", "s", 2)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_run_is_brute_force(spark, planted):
    folder, rows = planted
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    # Toxicity: the learned network applied to each text here.
    model, _ = toxicity.fit(docs, labels, crc_mod5() != 0)
    lang, logit = toxicity.scorer(*model.network.value)([r[1] for r in rows])
    left = [r[:2] for r, n, z in zip(rows, lang.tolist(), logit.tolist(), strict=True) if z < model.thresholds.get(n, model.thresholds[-1])]
    assert 120 < len(left) < len(rows)
    # Line dedup.
    left = cut_lines(left)
    # Near-duplicates: every pair.
    sets, group = [shingles(text) for _, text in left], list(range(len(left)))
    for i, j in combinations(range(len(left)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            group = [group[i] if g == group[j] else g for g in group]
    first = {}
    for (doc, text), g in zip(left, group, strict=True):
        first[g] = min(first.get(g, (doc is None, doc or 0, text)), (doc is None, doc or 0, text), key=lambda r: r[:2])
    left = [(None if none else doc, text) for none, doc, text in first.values()]
    assert len(left) < 180
    # Benchmark: every window of every item.
    found = {i for i, _ in brute_pairs([text or "" for _, text in left], ITEMS)}
    left = [r for i, r in enumerate(left) if i not in found]
    assert len(found) > 3
    # Packing.
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, want = Tokenizer.from_file(path), []
    for doc, text in left:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)))
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in got)
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from skirmish.llm import common

    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("Context", (), {"getConf": staticmethod(lambda: Cluster.conf), "master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.scratch_dir(Cluster)
