"""Embedding near-duplicates by Euclidean p-stable hashing.

Unit vectors at cosine c lie sqrt(2 - 2c) apart. A table takes k random projections, shifted and cut into cells of one
width; vectors that share all k cells of any of T tables are compared exactly, in double precision. k grows with the
logarithm of the number of vectors, and T follows from the wanted recall at the limit itself, by the collision
probability of Datar et al., "Locality-Sensitive Hashing Scheme Based on p-Stable Distributions" (2004); closer pairs
are found more surely, and a link that is reported is always true.

Equal vectors are merged first and linked by count. Vectors of one length are compared among themselves, each length
with projections of its own. What is dealt to buckets is a number and a 64-bit sign sketch (random hyperplanes); only
vectors with another's sketch near theirs in a bucket are fetched there and compared. A pair at the limit fails the
sketch with a probability below 1e-5; that is part of the planned recall. Buckets yield, for each vector, the number
of its links that no earlier table has seen, and links enough to connect what they connect, not all pairs. Buckets beyond
a limit are compared chunk by chunk in many tasks.

Cosines are products of unit vectors in double precision; those within rounding of the limit are settled in exact
arithmetic, so that the limit itself links and nothing below it does.

Vectors that are null, zero, or hold null or non-finite components link with nothing; they still have a row. Components of
other numeric types are read as doubles, floats stay floats. A null vec_id is compared like any other. Repeated rows are
copies of each other. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction
from functools import lru_cache
from math import acos, ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from skirmish.llm.cells import by_cell, chunk_pairs, runs
from skirmish.llm.common import cut, prepare
from skirmish.llm.components import components

MIN_COSINE, RECALL, WIDTH = 0.95, 0.97, 1.2
BUCKET_LIMIT = 4096
#: The low bits of a bucket's key are the number of its table.
TABLE_BITS = 10
ROUNDING = 1e-11


def collision(distance: float, width: float) -> float:
    """Probability that two points share the cell of one projection."""
    w = width / distance
    return erf(w / sqrt(2)) - sqrt(2 / pi) / w * (1 - exp(-w * w / 2))


def plan(n: int, min_cosine: float = MIN_COSINE, recall: float = RECALL, width: float = WIDTH) -> tuple[int, int]:
    """Projections to a table and tables, so that unrelated vectors (at right angles) share about one bucket each in
    all, while a pair at min_cosine shares one with probability `recall`."""
    near, far = collision(sqrt(2 - 2 * min_cosine), width), collision(sqrt(2), width)
    k = max(4, ceil(log(max(n, 2)) / -log(far)))
    return k, min(1 << TABLE_BITS, max(1, ceil(log(1 - recall) / log(1 - near**k))))


def sketch_distance(min_cosine: float, bits: int = 64) -> int:
    """Differing bits up to which two sketches are near: five and a half deviations above the mean at min_cosine."""
    share = acos(max(-1.0, min(1.0, min_cosine))) / pi
    return min(bits, ceil(bits * share + 5.5 * sqrt(bits * share * (1 - share))))


def usable(vector: str = "embedding"):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _lengths(column: pa.Array) -> np.ndarray:
    return np.diff(column.offsets.to_numpy())


def _by_length(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as a matrix) for each length of vectors."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = _lengths(flat)
    values, begin = flat.flatten().to_numpy(zero_copy_only=False), np.cumsum(n) - n
    for length in np.unique(n).tolist():
        rows = np.flatnonzero(n == length)
        yield rows, values[begin[rows][:, None] + np.arange(length)]


def units(x: np.ndarray) -> np.ndarray:
    """Rows of unit length in double precision; scaled first, so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@lru_cache(maxsize=512)
def _projections(length: int, k: int, table: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, length, table])
    return rng.standard_normal((length, k)), rng.uniform(0, width, k)


def bucket_keys(x: np.ndarray, k: int, tables: int, width: float, seed: int) -> np.ndarray:
    """A 64-bit key for each row of unit vectors and table; its low bits are the table's number."""
    out = np.empty((len(x), tables), np.uint64)
    low = np.uint64((1 << TABLE_BITS) - 1)
    for t in range(tables):
        directions, shift = _projections(x.shape[1], k, t, width, seed)
        cells = np.floor((x @ directions + shift) / width).astype(np.int64).view(np.uint64)
        mixed = np.full(len(x), x.shape[1], np.uint64)
        for j in range(k):
            mixed = (mixed ^ cells[:, j]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        out[:, t] = (mixed & ~low) | np.uint64(t)
    return out


def sketches(x: np.ndarray, seed: int) -> np.ndarray:
    """64 signs of random projections of each row."""
    directions, _ = _projections(x.shape[1], 64, -1 & 0xFFFF, 1.0, seed)
    return np.packbits(x @ directions >= 0, axis=1).view(np.uint64).ravel()


def with_near_sketch(key: np.ndarray, sketch: np.ndarray, distance: int, small: int = 24) -> np.ndarray:
    """Which rows have, in their run of equal keys, another whose sketch is near."""
    near = np.zeros(len(key), bool)
    bounds = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)] if len(key) else np.zeros(1, np.int64)
    sizes = np.diff(bounds)
    pos, size = np.arange(len(key)) - np.repeat(bounds[:-1], sizes), np.repeat(sizes, sizes)
    few = np.flatnonzero((size <= small) & (size > 1))
    for step in range(1, small):
        at = few[pos[few] + step < size[few]]
        if not len(at):
            break
        at = at[np.bitwise_count(sketch[at] ^ sketch[at + step]) <= distance]
        near[at] = near[at + step] = True
    for i in np.flatnonzero(sizes > small).tolist():
        own = sketch[bounds[i] : bounds[i + 1]]
        for at in range(0, len(own), 256):
            close = np.bitwise_count(own[at : at + 256, None] ^ own[None, :]) <= distance
            near[bounds[i] + at : bounds[i] + at + len(close)] = close.sum(1) > 1  # itself is one
    return near


def at_least(a: np.ndarray, b: np.ndarray, limit: Fraction) -> bool:
    """Whether the cosine of two vectors reaches a positive limit, exactly."""
    a, b = [Fraction(float(v)) for v in a], [Fraction(float(v)) for v in b]
    dot = sum(x * y for x, y in zip(a, b, strict=True))
    return dot > 0 and dot * dot >= limit * limit * sum(x * x for x in a) * sum(y * y for y in b)


def reaching(x: np.ndarray, y: np.ndarray, cosine: np.ndarray, min_cosine: float) -> np.ndarray:
    """Which cosines of rows of x and y reach the limit; those within rounding of it are settled exactly."""
    near, limit = cosine >= min_cosine, Fraction(str(min_cosine))
    for at in np.flatnonzero(np.abs(cosine - min_cosine) <= ROUNDING).tolist():
        near[at] = at_least(x[at], y[at], limit)
    return near


def link_small(x: np.ndarray, unit: np.ndarray, keys: np.ndarray, t: np.ndarray, pos: np.ndarray, size: np.ndarray, side: np.ndarray | None, min_cosine: float, small: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that link, and whether this table sees them first, of all buckets of at most `small` rows side by side; pos
    and size are each row's place in its bucket and the bucket's size."""
    few = np.flatnonzero((size <= small) & (size > 1))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, small):
        at = few[pos[few] + step < size[few]]
        if side is not None:
            at = at[side[at] != side[at + step]]
        near = at[reaching(x[at], x[at + step], np.einsum("ij,ij->i", unit[at], unit[at + step]), min_cosine)]
        left.append(near)
        right.append(near + step)
    a, b = np.concatenate(left), np.concatenate(right)
    before = np.arange(keys.shape[1]) < t[a][:, None]
    return a, b, ~((keys[a] == keys[b]) & before).any(1)


def link_bucket(no: np.ndarray, weight: np.ndarray, x: np.ndarray, unit: np.ndarray, keys: np.ndarray, side: np.ndarray | None, min_cosine: float) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Within one bucket: links that connect it, and for each vector the weight of the links first seen in this table;
    keys are those of earlier tables. With side, only pairs across sides count; pairs within one are another task's."""
    n = len(no)
    counts, links = np.zeros(n, np.int64), []
    label = np.arange(n)
    for at in range(0, n, 512):
        cosine = unit[at : at + 512] @ unit.T
        near = cosine >= min_cosine
        r, c = np.nonzero(np.abs(cosine - min_cosine) <= ROUNDING)
        near[r, c] = reaching(x[at + r], x[c], cosine[r, c], min_cosine)
        for r, row in enumerate(near, at):
            others = np.flatnonzero(row)
            others = others[others > r]
            if side is not None:
                others = others[side[others] != side[r]]
            if not len(others):
                continue
            fresh = others[~(keys[others] == keys[r]).any(1)]
            counts[r] += weight[fresh].sum()
            counts[fresh] += weight[r]
            for root in np.unique(label[others]).tolist():
                if root != label[r]:
                    to = others[np.argmax(label[others] == root)]
                    links.append((int(no[r]), int(no[to])))
                    label[label == root] = label[r]
    return links, counts


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, recall: float = RECALL, bucket_limit: int = BUCKET_LIMIT, seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors; min_cosine is above 0."""
    prepare(vectors.sparkSession)
    type_ = vectors.schema["embedding"].dataType
    kind = "float" if isinstance(type_, ArrayType) and isinstance(type_.elementType, FloatType) else "double"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{kind}>"))

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            n = _lengths(column)
            values = column.flatten().to_numpy(zero_copy_only=False) + 0.0  # -0.0 and 0.0 are one number
            ends = np.cumsum(n).tolist()
            name = np.frombuffer(b"".join(xxhash.xxh3_128_digest(values[e - k : e].tobytes()) for e, k in zip(ends, n.tolist(), strict=True)), np.int64).reshape(-1, 2)
            vectors_ = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values, column.type.value_type))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(name[:, 0]), pa.array(name[:, 1]), vectors_], ["vec_id", "h1", "h2", "embedding"])

    copies = cut(rows.where(usable()).mapInArrow(named, f"vec_id long, h1 long, h2 long, embedding array<{kind}>"))
    merged = copies.groupBy("h1", "h2").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
    points = cut(merged.withColumn("no", F.monotonically_increasing_id()))
    # One row for each length that vectors have.
    plans = {r["length"]: plan(r["n"], min_cosine, recall) for r in points.groupBy(F.size("embedding").alias("length")).agg(F.count("*").alias("n")).collect()}
    distance = sketch_distance(min_cosine)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _by_length(batch.column(1)):
                unit = units(x)
                k, tables = plans[x.shape[1]]
                keys = bucket_keys(unit, k, tables, WIDTH, seed).view(np.int64)
                no, sketch = batch.column(0).to_numpy()[at], sketches(unit, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(no, tables)), pa.array(np.repeat(sketch, tables))], ["key", "no", "sketch"])

    def active(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, table in runs(batches, bucket_limit):
            key, no = table["key"].to_numpy(), table["no"].to_numpy()
            if chunk is None:
                near = with_near_sketch(key, table["sketch"].to_numpy().view(np.uint64), distance)
                key, no = key[near], no[near]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(no), pa.array(np.full(len(key), -1 if chunk is None else chunk, np.int32))], ["key", "no", "chunk"])

    link, count = 0, 1

    def compare(table: pa.Table, second: bool, small: int = 8) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(kind, a, b): links (no, no) and counts (no, weight of links)."""
        for at, x in _by_length(table["embedding"]):
            key, no, weight, t = (table[c].to_numpy()[at] for c in ("key", "no", "weight", "t"))
            side = table["side"].to_numpy()[at] if second else None
            unit = units(x)
            keys = bucket_keys(unit, plans[x.shape[1]][0], int(t.max(initial=0)), WIDTH, seed)
            bounds = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
            if second:  # where a chunk meets itself there is one side, and all pairs count
                alone = np.repeat(np.maximum.reduceat(side, bounds[:-1]) == 0, np.diff(bounds))
                side = np.where(alone, np.arange(len(key)), side)
            sizes = np.diff(bounds)
            size = np.repeat(sizes, sizes)
            l, r, first = link_small(x, unit, keys, t, np.arange(len(key)) - np.repeat(bounds[:-1], sizes), size, side, min_cosine, small)
            counts = np.bincount(l[first], weight[r[first]], len(key)) + np.bincount(r[first], weight[l[first]], len(key))
            links = [np.stack([no[l[first]], no[r[first]]], 1)]
            for i in np.flatnonzero(sizes > small).tolist():
                own = slice(bounds[i], bounds[i + 1])
                made, counts[own] = link_bucket(no[own], weight[own], x[own], unit[own], keys[own, : t[bounds[i]]], None if side is None else side[own], min_cosine)
                links.append(np.array(made, np.int64).reshape(-1, 2))
            links, some = np.concatenate(links), np.flatnonzero(counts)
            yield np.full(len(links), link, np.int32), links[:, 0], links[:, 1]
            yield np.full(len(some), count, np.int32), no[some], counts[some].astype(np.int64)

    def compared(second: bool):
        def one(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, table in runs(batches, 2 * bucket_limit):
                for made in compare(table, second):
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, made)), ["kind", "a", "b"])

        return one

    first = cut(by_cell(points.select("no", "embedding").mapInArrow(deal, "key long, no long, sketch long")).mapInArrow(active, "key long, no long, chunk int"))
    first = first.withColumn("t", F.col("key").bitwiseAND((1 << TABLE_BITS) - 1))
    held, schema = points.select("no", "weight", "embedding"), "kind int, a long, b long"
    small = by_cell(first.where("chunk < 0").drop("chunk").join(held, "no").select("key", "t", "no", "weight", "embedding")).mapInArrow(compared(False), schema)
    large = chunk_pairs(first.where("chunk >= 0")).join(held, "no").select("key", "t", "no", "weight", "embedding", "side")
    found = cut(small.unionAll(by_cell(large).mapInArrow(compared(True), schema)))
    n_links = found.where(F.col("kind") == count).groupBy(F.col("a").alias("no")).agg(F.sum("b").alias("n_links"))
    groups = cut(components(found.where(F.col("kind") == link).select("a", "b"))).withColumnRenamed("node", "no")
    known = points.select("no", "h1", "h2", "first_id", "weight").join(n_links, "no", "left").join(groups, "no", "left").withColumn("component", F.coalesce("component", "no"))
    least = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_vector = known.join(least, "component").select("h1", "h2", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    linked = copies.select("vec_id", "h1", "h2").join(by_vector, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(usable(), F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
