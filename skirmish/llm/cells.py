"""Streaming over rows sorted by a cell key: whole cells where they are small, chunks where they are large.

Candidate search deals rows to cells and compares within each. Most cells are small and many come in one batch; a cell
with more than `limit` rows is handed on in chunks, which a second pass pairs up over many tasks, so that no task ever
holds more than two chunks and no pair is left out."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def runs(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[int | None, pa.Table]]:
    """(None, rows of whole cells, each of at most limit rows) or (chunk number, up to limit rows of one larger cell).

    The first column is the key; rows must come sorted by it."""
    rest: pa.Table | None = None
    open_key, n_open = None, 0
    for batch in _and_then_none(batches):
        if batch is not None:
            more = pa.Table.from_batches([batch])
            rest = more if rest is None else pa.concat_tables([rest, more])
        if rest is None or not len(rest):
            continue
        rest = rest.combine_chunks()
        key = rest.column(0).to_numpy()
        bounds = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
        whole = len(bounds) - (1 if batch is None else 2)
        big = np.diff(bounds)[:whole] > limit
        if whole and open_key == key[0]:
            big[0] = True
        if not big.all():
            small = rest.slice(0, bounds[whole])
            yield None, small.filter(pa.array(np.repeat(~big, np.diff(bounds)[:whole]))) if big.any() else small
        for i in np.flatnonzero(big):
            first = n_open if open_key == key[bounds[i]] else 0
            for n, at in enumerate(range(bounds[i], bounds[i + 1], limit)):
                yield first + n, rest.slice(at, min(limit, bounds[i + 1] - at))
        last, rest = key[bounds[whole]] if whole < len(bounds) - 1 else None, rest.slice(bounds[whole])
        if last is None or open_key != last:
            open_key, n_open = None, 0
        while len(rest) > limit:
            yield n_open, rest.slice(0, limit)
            open_key, n_open, rest = last, n_open + 1, rest.slice(limit)


def _and_then_none(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def chunk_pairs(chunks: DataFrame) -> DataFrame:
    """From rows (key, chunk, ...) of large cells: each row once for every pair of chunks that its own belongs to, under
    the pair's key, with `side` 0 or 1 (both 0 where a chunk meets itself)."""
    number = chunks.groupBy("key").agg((F.max("chunk") + 1).alias("n_chunks"))
    each = chunks.join(number, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    paired = each.withColumn("key", F.xxhash64("key", low, high)).withColumn("side", (F.col("chunk") > F.col("other")).cast("int"))
    return paired.drop("chunk", "other", "n_chunks")


def by_cell(df: DataFrame, *order: str) -> DataFrame:
    """Rows of a key together and sorted, as runs() needs them, within a key by `order`; the number of partitions is the
    session's."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "key").sortWithinPartitions("key", *order)
