"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint becomes the vector of the bit counts of its 32 two-bit segments. One differing bit moves one coordinate by
one, so the Manhattan distance of two vectors is at most the Hamming distance of their fingerprints, and a range join
of the vectors loses no link. The join's grid: coordinates are dealt to B blocks; of two vectors within distance r,
at least B - r blocks are equal, so each choice of B - r blocks makes a grid in which the cell is the equal part.
Within a cell the Manhattan distance is checked first, then the fingerprints themselves. B is taken from the number of
different fingerprints, so that cells stay small at any size; the links found don't depend on it.

Cells give links that connect what they connect, not all their pairs: a group of n near copies costs about n links.
Components are then found by star contraction. Equal fingerprints are merged before the search.

Null or blank text has no words and the fingerprint zero; it links like any other. Repeated rows and ties are
rows of the same class. The component of rows is named by the smallest doc_id in it, nulls left aside; it is null only
where all ids in it are. Extra columns are ignored by near_duplicates() and kept by representatives().
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.cells import by_cell, chunk_pairs, runs
from skirmish.llm.common import columns_of, cut, drop_cut, prepare, text_hash
from skirmish.llm.components import components

SHINGLE_WORDS, MAX_DISTANCE, SEED = 4, 4, 42
LOW = 0x5555555555555555  # the low bit of each two-bit segment
#: Rows of a cell that one task compares at once.
CELL_LIMIT = 8192


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of word shingles; text is lower-cased already."""
    tokens = text.split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest = xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1].tolist()
    ends = ends.tolist()
    n, counts = len(tokens) - words + 1, np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        to = min(n, at + 65536)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:to], ends[at + words - 1 : to + words - 1], strict=True)], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes())


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    prepare(docs.sparkSession)

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint((t.as_py() or b"").lower(), words) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(made, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(make, "doc_id long, fp long")


def embedding(fp: np.ndarray) -> np.ndarray:
    """The 32 bit counts of each fingerprint, two bits each, in one number."""
    return fp - ((fp >> np.uint64(1)) & np.uint64(LOW))


def manhattan(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of embedded fingerprints: a segment's counts differ by 1 if their low bits differ, by 2 if only the high ones do."""
    x = p ^ q
    two = (x >> np.uint64(1)) & ~x
    two &= np.uint64(LOW)
    x &= np.uint64(LOW)
    return np.bitwise_count(x) + 2 * np.bitwise_count(two)


def block_masks(n_blocks: int, distance: int) -> list[int]:
    """For each choice of blocks that may be equal, the mask of their segments."""
    segments = [0] * n_blocks
    for s in range(32):
        segments[s % n_blocks] |= 3 << (2 * s)
    return [sum(segments[b] for b in chosen) for chosen in combinations(range(n_blocks), n_blocks - distance)]


def choose_blocks(n: int, distance: int) -> int:
    """Blocks that make rows dealt out plus expected chance pairs least; equal chance segments have 1.415 bits."""
    cost = {b: comb(b, distance) * (n + n * n / 2 * 2.0 ** (-1.415 * 32 * (b - distance) / b)) for b in range(distance + 1, 17)}
    return min(cost, key=cost.get)


def _close(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    near = np.flatnonzero(manhattan(embedding(a), embedding(b)) <= distance)
    return near[np.bitwise_count(a[near] ^ b[near]) <= distance]


def link_cells(key: np.ndarray, fp: np.ndarray, distance: int, small: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within each run of equal keys, all that is within the distance."""
    left, right = [], []
    bounds = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
    sizes = np.diff(bounds)
    pos = np.arange(len(key)) - np.repeat(bounds[:-1], sizes)
    size = np.repeat(sizes, sizes)
    few = np.flatnonzero((size <= small) & (size > 1))
    for step in range(1, small):
        at = few[pos[few] + step < size[few]]
        if not len(at):
            break
        hit = _close(fp[at], fp[at + step], distance)
        left.append(fp[at[hit]])
        right.append(fp[at[hit] + step])
    for i in np.flatnonzero(sizes > small):
        unseen = np.unique(fp[bounds[i] : bounds[i + 1]])
        front: list[int] = []
        while len(unseen):
            # Breadth first: what a member reaches leaves the cell, so a dense group is gone after few looks.
            if not front:
                front, unseen = [int(unseen[0])], unseen[1:]
            node = np.uint64(front.pop())
            hit = _close(np.broadcast_to(node, unseen.shape), unseen, distance)
            if len(hit):
                found = unseen[hit]
                left.append(np.full(len(found), node))
                right.append(found)
                front += found.tolist()
                unseen = np.delete(unseen, hit)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def links(fps: DataFrame, distance: int = MAX_DISTANCE, n_blocks: int | None = None, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(a, b): links between different fingerprints (column fp, no repeats) whose components are those of all links
    within the distance."""
    masks = block_masks(n_blocks or choose_blocks(max(2, fps.count()), distance), distance)
    # hi + lo of each segment, by bits alone: a sum of longs would overflow.
    embedded = F.expr(f"shiftleft(fp & shiftrightunsigned(fp, 1) & {LOW}L, 1) | ((fp ^ shiftrightunsigned(fp, 1)) & {LOW}L)")
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = fps.withColumn("p", embedded).select("fp", "p", F.posexplode(F.lit(signed)).alias("grid", "mask"))
    cells = by_cell(dealt.select(F.xxhash64("grid", F.col("p").bitwiseAND(F.col("mask"))).alias("key"), "fp"))

    def within(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in runs(batches, cell_limit):
            key, fp = rows.column("key").to_numpy(), rows.column("fp").to_numpy().view(np.uint64)
            a, b = link_cells(key, fp, distance)
            made = [a.view(np.int64), b.view(np.int64), np.full(len(a), -1, np.int32)]
            if chunk is not None:  # of a large cell: its rows go to the second pass, as (key, fp, chunk)
                made = [np.r_[x, y] for x, y in zip(made, (key, fp.view(np.int64), np.full(len(fp), chunk, np.int32)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["a", "b", "chunk"])

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, 2 * cell_limit):
            a, b = link_cells(rows.column("key").to_numpy(), rows.column("fp").to_numpy().view(np.uint64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    first = cut(cells.mapInArrow(within, "a long, b long, chunk int"))
    large = first.where("chunk >= 0").select(F.col("a").alias("key"), F.col("b").alias("fp"), "chunk")
    second = by_cell(chunk_pairs(large).select("key", "fp")).mapInArrow(across, "a long, b long")
    return first.where("chunk < 0").select("a", "b").unionAll(second)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, n_blocks: int | None = None, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """doc_id, fp, component_id for each row of docs."""
    rows = cut(fingerprints(docs, words))
    classes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")))
    found = cut(components(links(classes.select("fp"), distance, n_blocks, cell_limit)))
    named = classes.join(found, classes.fp == found.node, "left").select("fp", "first_doc", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    by_fp = named.join(least, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---- near-duplicates by the similarity of shingle sets

SIMILARITY, SIMILAR_WORDS, RECALL = 0.8, 5, 0.95
WIDE = 128
#: Rows with more others near in their cell are compared with their sets at hand, so many rows of a chunk.
MANY, SETS_LIMIT = 4, 2048


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """(n, 2) 128-bit hashes of the different word shingles of lower-cased text, sorted; none for a blank text."""
    tokens = text.split()
    if not tokens:
        return np.zeros((0, 2), np.uint64)
    joined, digest = b" ".join(tokens), xxhash.xxh3_128_digest
    if len(tokens) <= words:
        made = digest(joined)
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = [0, *(ends[:-words] + 1).tolist()]
        made = b"".join([digest(joined[s:e]) for s, e in zip(starts, ends[words - 1 :].tolist(), strict=True)])
    both = np.frombuffer(made, np.uint64).reshape(-1, 2)
    _, first = np.unique(both[:, 0], return_index=True)
    return both[first]


def wide_fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """The 128-bit SimHash of a set of shingles, as two halves."""
    counts = np.zeros(WIDE, np.int64)
    for at in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, WIDE // 8), axis=1).sum(0, dtype=np.int64)
    a, b = np.packbits(2 * counts > max(1, len(hashes))).view(np.uint64)
    return int(a), int(b)


def differing(similarity: float) -> float:
    """Expected share of differing bits of two sets of that Jaccard similarity and equal size."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def choose_grids(n: int, similarity: float, recall: float) -> tuple[int, int]:
    """Segments to a grid and number of grids: together a pair of that similarity shares a cell of one of them with
    probability `recall`, at least cost in rows dealt out and chance pairs."""
    d = differing(similarity)
    equal = (1 - d) ** 2 + d * d / 2  # a segment's count stays: no bit differs, or both do and cancel
    grids = {s: int(np.ceil(np.log(1 - recall) / np.log(1 - equal**s))) for s in range(4, 33)}
    cost = {s: t * (n + n * n / 2 * 0.375**s / 100) for s, t in grids.items()}
    best = min(cost, key=cost.get)
    return best, grids[best]


def grid_masks(segments: int, grids: int, seed: int = 13) -> list[tuple[int, int]]:
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(grids):
        mask = sum(3 << (2 * int(s)) for s in rng.choice(WIDE // 2, segments, replace=False))
        out.append((mask & ((1 << 64) - 1), mask >> 64))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Wide:
    """128-bit fingerprints in halves, with their embeddings."""

    def __init__(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a, self.b, self.p, self.q = a, b, embedding(a), embedding(b)

    def close(self, i: np.ndarray | int, j: np.ndarray, distance: int) -> np.ndarray:
        """Where rows i and j are within the distance."""
        near = np.flatnonzero(manhattan(self.p[i], self.p[j]) + manhattan(self.q[i], self.q[j]) <= distance)
        if not len(near):
            return near
        i, j = i if isinstance(i, int) else i[near], j[near]
        return near[np.bitwise_count(self.a[i] ^ self.a[j]).astype(np.int64) + np.bitwise_count(self.b[i] ^ self.b[j]) <= distance]


def close_in_cells(key: np.ndarray, no: np.ndarray, a: np.ndarray, b: np.ndarray, distance: int, small: int = 64, many: int = MANY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (no, no) within the distance in each run of equal keys, and core rows: those of runs of more than `small` rows
    that have more than `many` others near. Pairs of two core rows aren't among the pairs."""
    wide, core = Wide(a, b), np.zeros(len(key), bool)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    pos, size = _places(key)
    few = np.flatnonzero((size <= small) & (size > 1))
    for step in range(1, small):
        at = few[pos[few] + step < size[few]]
        if not len(at):
            break
        hit = at[wide.close(at, at + step, distance)]
        left.append(no[hit])
        right.append(no[hit + step])
    for lo in np.flatnonzero((pos == 0) & (size > small)).tolist():
        n = int(size[lo])
        rows, near, total, held = np.arange(lo, lo + n), np.zeros(n, np.int64), 0, []
        for i in range(n - 1):
            hit = wide.close(lo + i, rows[i + 1 :], distance) + i + 1
            if len(hit):
                near[i] += len(hit)
                near[hit] += 1
                total += len(hit)
                if total <= 64 * n:
                    held.append((i, hit))
        light = near <= many
        core[lo : lo + n] = ~light
        if total > 64 * n:  # too many to hold: those of light rows once more
            held = [(i, hit[hit != i]) for i in np.flatnonzero(light & (near > 0)).tolist() for hit in [wide.close(lo + i, rows, distance)]]
            held = [(i, hit[(hit > i) | ~light[hit]]) for i, hit in held]
        held = [(i, hit if light[i] else hit[light[hit]]) for i, hit in held]
        for i, hit in held:
            left.append(np.full(len(hit), no[lo + i]))
            right.append(no[lo + hit])
    return np.concatenate(left), np.concatenate(right), core


def _places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row its place in its run of equal keys and the run's size."""
    bounds = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)] if len(key) else np.zeros(1, np.int64)
    sizes = np.diff(bounds)
    return np.arange(len(key)) - np.repeat(bounds[:-1], sizes), np.repeat(sizes, sizes)


def similar_in_cells(key: np.ndarray, no: np.ndarray, a: np.ndarray, b: np.ndarray, sets: list[np.ndarray], distance: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within each run of equal keys, all pairs within the distance whose sets are similar. Only a
    pair of similar sets takes a row out of the cell; a row that fails stays for all others to look at."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    pos, size = _places(key)
    for lo in np.flatnonzero(pos == 0):
        hi = lo + size[lo]
        n = np.array([len(x) for x in sets[lo:hi]], np.int64)
        values, ids = np.unique(np.concatenate(sets[lo:hi]), return_inverse=True)
        ends, mine = np.cumsum(n), np.zeros(len(values), bool)
        wide = Wide(a[lo:hi], b[lo:hi])
        of = lambda r: ids[ends[r] - n[r] : ends[r]]  # noqa: B023, E731
        unseen, front = np.flatnonzero(n), []
        while len(unseen):
            if not front:
                front, unseen = [int(unseen[0])], unseen[1:]
            node = front.pop()
            asked = wide.close(node, unseen, distance)
            near = unseen[asked]
            asked = asked[np.minimum(n[near], n[node]) / np.maximum(n[near], n[node]) >= similarity]
            near = unseen[asked]
            if not len(near):
                continue
            mine[of(node)] = True
            shared = np.add.reduceat(mine[np.concatenate([of(r) for r in near])].astype(np.int64), np.r_[0, np.cumsum(n[near])[:-1]])
            mine[of(node)] = False
            good = shared / (n[near] + n[node] - shared) >= similarity
            left.append(np.full(good.sum(), no[lo + node]))
            right.append(no[lo + near[good]])
            front += near[good].tolist()
            unseen = np.delete(unseen, asked[good])
    return np.concatenate(left), np.concatenate(right)


def similar_documents(docs: DataFrame, words: int = SIMILAR_WORDS, similarity: float = SIMILARITY, recall: float = RECALL, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """doc_id, t1, t2 (a hash of the text), component_id, stays for each row of docs: components of documents whose sets
    of word shingles have at least that Jaccard similarity. component_id is the smallest doc_id of the component, null
    only where all its ids are; stays marks the rows with that id and, of several texts under it, the least hash.

    At this radius no choice of equal blocks is both sure and selective. The grids are random choices of segments of a
    128-bit fingerprint's embedding instead, as many as make a pair at the limit itself meet with probability `recall`;
    closer pairs meet more surely. Cells check the Manhattan bound and the fingerprints' distance as before, and every
    candidate pair is then held to the similarity of its two shingle sets. Cells hand on their pairs; only between rows that
    have many others near, whose pairs grow with the square of a group, the sets come to the cell instead. Equal sets are
    merged first."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_hash(), F.col("text").cast("string").alias("text"))

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text in batch.column(3).cast(pa.binary()):
                hashes = shingle_hashes((text.as_py() or b"").lower(), words)
                made.append((*np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.uint64).tolist(), *wide_fingerprint(hashes)))
            columns = np.array(made, np.uint64).reshape(-1, 4).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, columns.T)], ["doc_id", "t1", "t2", "set1", "set2", "a", "b"])

    known = cut(rows.mapInArrow(make, "doc_id long, t1 long, t2 long, set1 long, set2 long, a long, b long"))
    least_row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")).alias("first_row")
    classes = cut(known.groupBy("set1", "set2").agg(least_row, F.first("a").alias("a"), F.first("b").alias("b")).withColumn("no", F.monotonically_increasing_id()))
    share = differing(similarity)
    distance = int(WIDE * share + 3 * np.sqrt(WIDE * share * (1 - share)))
    masks = grid_masks(*choose_grids(max(2, classes.count()), similarity, recall))
    embed = lambda c: F.expr(f"shiftleft({c} & shiftrightunsigned({c}, 1) & {LOW}L, 1) | (({c} ^ shiftrightunsigned({c}, 1)) & {LOW}L)")
    grid = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(x)).alias("x"), F.lit(_signed(y)).alias("y")) for i, (x, y) in enumerate(masks)]))
    dealt = classes.select("no", "a", "b", embed("a").alias("pa"), embed("b").alias("pb"), grid.alias("g"))
    cells = by_cell(dealt.select(F.xxhash64("g.i", F.col("pa").bitwiseAND(F.col("g.x")), F.col("pb").bitwiseAND(F.col("g.y"))).alias("key"), "no", "a", "b"), "a", "b")  # a large cell's chunks follow its order
    columns = lambda t: (t["key"].to_numpy(), t["no"].to_numpy(), t["a"].to_numpy().view(np.uint64), t["b"].to_numpy().view(np.uint64))

    def compared(table: pa.Table) -> list[np.ndarray]:
        """(no, no, -1) of pairs and (key, no, -2 - chunk) of core rows."""
        key, no, a, b = columns(table)
        left, right, core = close_in_cells(key, no, a, b, distance)
        chunk = _places(key[core])[0] // SETS_LIMIT
        return [np.r_[left, key[core]], np.r_[right, no[core]], np.r_[np.full(len(left), -1), -2 - chunk].astype(np.int32)]

    def within(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, table in runs(batches, cell_limit):
            # Chunks of a large cell go to the second pass, as (key, no, chunk).
            made = compared(table) if chunk is None else [table["key"].to_numpy(), table["no"].to_numpy(), np.full(len(table), chunk, np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["l", "r", "chunk"])

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in runs(batches, 2 * cell_limit):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in compared(table)], ["l", "r", "chunk"])

    def with_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in runs(batches, 2 * SETS_LIMIT):
            shingles = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, similar_in_cells(*columns(table), shingles, distance, similarity))), ["l", "r"])

    first = cut(cells.mapInArrow(within, "l long, r long, chunk int"))
    large = first.where("chunk >= 0").select(F.col("l").alias("key"), F.col("r").alias("no"), "chunk")
    second = cut(by_cell(chunk_pairs(large).join(classes.select("no", "a", "b"), "no").select("key", "no", "a", "b"), "a", "b").mapInArrow(across, "l long, r long, chunk int"))
    both = first.unionAll(second)
    pairs = cut(both.where("chunk = -1").select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r")).distinct())
    core = both.where("chunk < -1").select(F.col("l").alias("key"), F.col("r").alias("no"), (-2 - F.col("chunk")).alias("chunk"))

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text in batch.column(1).cast(pa.binary()):
                made.append(shingle_hashes((text.as_py() or b"").lower(), words)[:, 0].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["no", "shingles"])

    asked = pairs.select(F.col("l").alias("no")).unionAll(pairs.select(F.col("r").alias("no"))).unionAll(core.select("no")).distinct()
    wanted = classes.join(asked, "no").select("no", "first_row.*")
    texts = rows.join(wanted.toDF("no", "none", "d", "t1", "t2"), ["t1", "t2"]).where(F.col("doc_id").eqNullSafe(F.col("d"))).select("no", "text")
    held = cut(texts.mapInArrow(sets, "no long, shingles binary").dropDuplicates(["no"]))

    @F.pandas_udf("double")
    def jaccard(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            out.append(shared / max(1, len(x) + len(y) - shared))
        return pd.Series(out, dtype=float)

    both = pairs.join(held.select(F.col("no").alias("l"), F.col("shingles").alias("x")), "l").join(held.select(F.col("no").alias("r"), F.col("shingles").alias("y")), "r")
    dense = chunk_pairs(core).join(classes.select("no", "a", "b"), "no").join(held, "no").select("key", "no", "a", "b", "shingles")
    verified = by_cell(dense, "a", "b").mapInArrow(with_sets, "l long, r long")
    found = cut(components(both.where(jaccard("x", "y") >= similarity).select("l", "r").unionAll(verified).toDF("a", "b")))
    for done in (first, second, pairs, held):
        drop_cut(done)
    named = classes.join(found, classes.no == found.node, "left").select("set1", "set2", "first_row", F.coalesce("component", "no").alias("component"))
    least = named.groupBy("component").agg(F.min("first_row").alias("first"))
    by_set = named.join(least, "component").select("set1", "set2", "first")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("t1") == F.col("first.t1")) & (F.col("t2") == F.col("first.t2"))
    return known.join(by_set, ["set1", "set2"]).select("doc_id", "t1", "t2", F.col("first.doc_id").alias("component_id"), stays.alias("stays"))


def representatives(docs: DataFrame, words: int = SIMILAR_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that stand for their component, one of each group: that of the smallest doc_id. Rows are told apart
    by id and text, so different texts under one id are rows of their own, and rows without an id take part; they stay
    where no row of their group has one. Of repeated rows one stays."""
    found = similar_documents(docs, words, similarity)
    keys = cut(found.groupBy("doc_id", "t1", "t2").agg(F.first("stays").alias("stays"), F.count("*").alias("n")))
    # All columns travel as one, so that none can clash.
    rows = docs.select(F.struct(*columns_of(docs)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *text_hash())
    same = lambda k: (rows.t1 == k.t1) & (rows.t2 == k.t2) & rows.doc_id.eqNullSafe(k.doc_id)
    # Those that go or repeat are the fewer; the others' texts needn't move if these fit a broadcast.
    other, several = keys.where("not stays or n > 1"), keys.where("stays and n > 1")
    once = rows.join(other, same(other), "left_anti")
    again = rows.join(several, same(several), "left_semi").dropDuplicates(["doc_id", "t1", "t2"])
    return once.select("row.*").unionAll(again.select("row.*"))
