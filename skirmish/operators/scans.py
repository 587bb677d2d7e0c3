"""Prefix scans over ordered rows, without a task that holds a key or a table.

Rows are dealt by ranges of (key, order), sorted and checkpointed, so that a task holds a contiguous stretch of the order and a
key of any size lies in as many tasks as its rows need. A scan is then two passes over these stretches, in place: the first
sums up what the last key of each stretch does to any state that may enter (a small value, as such effects compose); the
driver walks over one summary a stretch and finds the state that enters each; the second pass replays the rows with it. Only
one key of a stretch can go on into the next, so summaries are as many as tasks. With no key the whole table is one.

Null keys are a key of their own and come first. Rows equal in key and order follow in any order. Batches are read one by one, so
a task holds a batch and a state. An empty table has no stretches and gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from skirmish.shipping import checkpointed, ship

STRETCH = "_stretch"
#: Beyond any clamp.
FAR = 1 << 62


class Scan(Protocol):
    """What happens to a state over rows, a batch at a time as {column: numpy array}."""

    reads: list[str]
    gives: str  # the new columns, as a schema
    start: Any

    def summary(self, rows: dict[str, np.ndarray]) -> Any: ...
    def then(self, first: Any, second: Any) -> Any: ...
    def apply(self, summary: Any, state: Any) -> Any: ...
    def replay(self, rows: dict[str, np.ndarray], firsts: np.ndarray, state: Any) -> tuple[list[np.ndarray], Any]: ...


def clamps(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of maps x -> min(max(x + a, low), high), one a row, what all up to each row do together: such a map again. A constant
    is a map with low = high. Doubling: after k rounds a row holds the 2^k maps up to it."""
    a, low, high, far = a.astype(np.int64), low.astype(np.int64), high.astype(np.int64), 1
    while far < len(a):
        new_low = np.clip(low[:-far] + a[far:], low[far:], high[far:])
        new_high = np.clip(high[:-far] + a[far:], low[far:], high[far:])
        a = np.concatenate([a[:far], a[:-far] + a[far:]])
        low, high = np.concatenate([low[:far], new_low]), np.concatenate([high[:far], new_high])
        far *= 2
    return a, low, high


def clamped(a: np.ndarray, low: np.ndarray, high: np.ndarray, firsts: np.ndarray, start: int, state: int) -> np.ndarray:
    """The value after each row; where a key begins it is `start` before, at the first row else `state`."""
    begun = np.clip(start + a, low, high)
    a, low, high = clamps(np.where(firsts, 0, a), np.where(firsts, begun, low), np.where(firsts, begun, high))
    return np.clip(state + a, low, high)


def before(after: np.ndarray, firsts: np.ndarray, start: Any, state: Any) -> np.ndarray:
    return np.where(firsts, start, np.concatenate([[state], after[:-1]]))


@dataclass
class Counter:
    """A whole number that moves by `amount` and stays between low and high, where given. Gives name_before and name."""

    name: str
    amount: str
    start: int = 0
    low: int = -FAR
    high: int = FAR

    @property
    def reads(self) -> list[str]:
        return [self.amount]

    @property
    def gives(self) -> str:
        return f"{self.name}_before long, {self.name} long"

    def _maps(self, rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = rows[self.amount]
        return a, np.full(len(a), self.low), np.full(len(a), self.high)

    def summary(self, rows: dict[str, np.ndarray]) -> tuple[int, int, int]:
        return tuple(int(x[-1]) for x in clamps(*self._maps(rows)))

    def then(self, first: tuple[int, int, int], second: tuple[int, int, int]) -> tuple[int, int, int]:
        return first[0] + second[0], self.apply(second, first[1]), self.apply(second, first[2])

    def apply(self, summary: tuple[int, int, int], state: int) -> int:
        a, low, high = summary
        return min(max(state + a, low), high)

    def replay(self, rows: dict[str, np.ndarray], firsts: np.ndarray, state: int) -> tuple[list[np.ndarray], int]:
        after = clamped(*self._maps(rows), firsts, self.start, state)
        return [before(after, firsts, self.start, state), after], int(after[-1])


@dataclass
class LastSeen:
    """The latest `value` of rows where `when` holds, before each row and up to it; `start` as long as there is none."""

    name: str
    value: str
    when: str
    start: int = 0

    @property
    def reads(self) -> list[str]:
        return [self.value, self.when]

    @property
    def gives(self) -> str:
        return f"{self.name}_before long, {self.name} long"

    def summary(self, rows: dict[str, np.ndarray]) -> int | None:
        hit = np.flatnonzero(rows[self.when])
        return int(rows[self.value][hit[-1]]) if len(hit) else None

    def then(self, first: int | None, second: int | None) -> int | None:
        return first if second is None else second

    def apply(self, summary: int | None, state: int) -> int:
        return state if summary is None else summary

    def replay(self, rows: dict[str, np.ndarray], firsts: np.ndarray, state: int) -> tuple[list[np.ndarray], int]:
        known = np.maximum.accumulate(np.where(rows[self.when] | firsts, np.arange(len(firsts)), -1))
        after = np.where(known < 0, state, np.where(rows[self.when][known], rows[self.value][known], self.start))
        return [before(after, firsts, self.start, state), after], int(after[-1])


# ---- running them


@dataclass
class Ordered:
    """Rows in stretches of the order of (key, order)."""

    rows: DataFrame
    key: list[str]

    def result(self) -> DataFrame:
        return self.rows.drop(STRETCH)

    def select(self, *columns: Any) -> Ordered:
        """Row by row, without the order being left."""
        return Ordered(self.rows.select(*columns, STRETCH), self.key)

    def with_columns(self, **columns: Any) -> Ordered:
        return Ordered(self.rows.withColumns(columns), self.key)


def ordered(rows: DataFrame, key: list[str], order: list[str]) -> Ordered:
    ship(rows.sparkSession)
    dealt = rows.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order)
    return Ordered(checkpointed(dealt.withColumn(STRETCH, F.spark_partition_id())), key)


def _columns(batch: pa.RecordBatch, names: list[str]) -> dict[str, np.ndarray]:
    """Numbers and truths of a batch; nulls are 0 and false."""
    return {n: batch.column(n).fill_null(False if pa.types.is_boolean(batch.column(n).type) else 0).to_numpy(zero_copy_only=False) for n in names}


def _firsts(batch: pa.RecordBatch, key: list[str], last: tuple | None) -> tuple[np.ndarray, tuple]:
    """(where a key begins that isn't the one before it, the last row's key)"""
    out = np.zeros(batch.num_rows, bool)
    out[0] = last is None or tuple(batch.column(k)[0].as_py() for k in key) != last
    for k in key:
        codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    return out, tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in key)


def _summaries(held: Ordered, how: Scan) -> Iterator[tuple[int, tuple, tuple, bool, Any]]:
    """(stretch, first key, last key, whether the last began in it, what its rows do), in the order of stretches."""
    key = held.key

    def sum_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = first = last = summary = None
        begun = False
        for batch in batches:
            if not batch.num_rows:
                continue
            if stretch is None:
                stretch = batch.column(STRETCH)[0].as_py()
                first = last = tuple(batch.column(k)[0].as_py() for k in key)
            firsts, last = _firsts(batch, key, last)
            tail = int(np.flatnonzero(firsts)[-1]) if firsts.any() else 0
            begun |= bool(firsts.any())
            part = how.summary({n: c[tail:] for n, c in _columns(batch, how.reads).items()})
            summary = part if summary is None or firsts.any() else how.then(summary, part)
        if stretch is not None:
            yield pa.RecordBatch.from_pydict({"stretch": pa.array([stretch], pa.int32()), "said": pa.array([pickle.dumps((first, last, begun, summary))], pa.binary())})

    read = held.rows.select(*dict.fromkeys([*key, *how.reads, STRETCH]))
    said = read.mapInArrow(sum_up, "stretch int, said binary").collect()  # one small row a task
    return ((r["stretch"], *pickle.loads(bytes(r["said"]))) for r in sorted(said, key=lambda r: r["stretch"]))


def scan(held: Ordered, how: Scan) -> Ordered:
    """The rows with the columns that the scan gives."""
    spark, key = held.rows.sparkSession, held.key
    enters: dict[int, tuple[tuple, Any]] = {}
    before_key, state = None, how.start
    for stretch, first, last, begun, summary in _summaries(held, how):
        goes_on = before_key == first
        if goes_on:
            enters[stretch] = first, state
        state = how.apply(summary, state if goes_on and not begun else how.start)
        before_key = last
    sent = spark.sparkContext.broadcast(enters)  # a state a task
    new = StructType.fromDDL(how.gives)
    schema, types = StructType([*held.rows.schema.fields, *new.fields]), [to_arrow_type(f.dataType) for f in new.fields]

    def replay(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, known = None, how.start, False
        for batch in batches:
            if not batch.num_rows:
                continue
            if not known:
                last, state = sent.value.get(batch.column(STRETCH)[0].as_py(), (None, how.start))
                known = True
            firsts, last = _firsts(batch, key, last)
            made, state = how.replay(_columns(batch, how.reads), firsts, state)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, made, types)], [f.name for f in schema.fields])

    return Ordered(held.rows.mapInArrow(replay, schema), key)


def numbered(rows: DataFrame, order: list[str], name: str = "place", count: str | None = None) -> DataFrame:
    """The rows with their place, from 0, in one order of the whole table; with `count` the sum of that column over all rows before."""
    one = rows if count else rows.withColumn("_one", F.lit(1))
    held = scan(ordered(one, [], order), Counter("_n", count or "_one"))
    return held.result().withColumn(name, F.col("_n_before")).drop("_n_before", "_n", "_one")
