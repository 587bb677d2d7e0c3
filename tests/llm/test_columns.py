"""Columns with dots and backquotes in their names pass through every operator and stage that returns whole rows."""

import pytest
from helpers import DOCS, prose
from pyspark.sql import functions as F

import corpus_pipeline
from skirmish.llm import decontamination, line_dedup, simhash, toxicity


@pytest.fixture(scope="module")
def docs(spark):
    line = "A line that all of these documents hold in common."
    rows = [(i, f"{prose(i, 60)}\n{line}", "en", None, 9) for i in range(5)] + [(None, f"{prose(9, 50)}\n{line}", None, "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({"a.b": F.lit(1), "c`d": F.col("doc_id"), "row": F.lit("x"), "e.f.g": F.array(F.lit(2))})


def same(got, docs):
    assert got.columns == docs.columns and got.schema["a.b"].dataType == docs.schema["a.b"].dataType
    rows = got.collect()
    assert all(r["a.b"] == 1 and r["c`d"] == r["doc_id"] and r["e.f.g"] == [2] for r in rows)
    return len(rows)


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_BYTES, 0])
def test_line_dedup(docs, limit):
    got = line_dedup.dedup(docs, broadcast_bytes=limit)
    assert same(got.drop("n_lines", "n_dropped", "kept_text", "kept_sha256"), docs) == 6
    assert got.agg(F.sum("n_dropped")).first()[0] == 5


def test_stages(spark, docs):
    assert same(corpus_pipeline.drop_repeated_lines(spark, docs, ""), docs) == 6
    assert same(simhash.representatives(docs), docs) == 6
    bench = spark.createDataFrame([(1, prose(2, 60))], "item_id long, text string")
    assert same(decontamination.clean(docs, bench), docs) == 5
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, toxic int")
    model, points = toxicity.fit(docs, labels, F.lit(True))
    same(toxicity.without_toxic(docs, points, model), docs)
