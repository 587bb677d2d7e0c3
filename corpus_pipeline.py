"""A cleaning pipeline over `documents`: toxicity, line de-duplication, near-duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the columns
of documents. Every stage's result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skirmish.llm import decontamination, line_dedup, packing, simhash, toxicity
from skirmish.llm.common import columns_of, crc_mod5, cut, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under 0.5, unchanged. It learns from labelled rows outside the held-out fifth."""
    model, points = toxicity.fit(docs, read(spark, sf_dir, "labels"), crc_mod5() != 0)
    return toxicity.without_toxic(docs, points, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of lines that three or more hold, only the largest doc_id keeps its own. n_chars follows the text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # Other columns travel as one, whatever their names.
    columns = dict(zip(docs.columns, columns_of(docs), strict=True))
    kept = line_dedup.dedup(docs.select("doc_id", "text", F.struct(*[columns[c] for c in rest]).alias("rest")))
    new = {c: F.col("rest")[c] for c in rest} | {"doc_id": F.col("doc_id"), "text": F.when(F.col("text").isNotNull(), F.col("kept_text"))}
    if "n_chars" in rest:
        new["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(new["n_chars"])
    return kept.select(*[new[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near-duplicates."""
    return simhash.representatives(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no region of a benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: A trained classifier, fingerprints and a tokenizer can't be said in SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
