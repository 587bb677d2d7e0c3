"""Steps on the map. Walls stand on its edge only, so x and y are walks of their own, clamped inside the edge."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.operators.encounters import begins
from skirmish.operators.scans import Counter, LastSeen, Ordered, before, clamped, clamps, ordered, scan
from skirmish.sources.dims import MAP_H, MAP_W, START, tile

# The keys that move, with dx, dy and facing.
DIRECTIONS = {"ArrowUp": (0, -1, "UP"), "KeyW": (0, -1, "UP"), "ArrowDown": (0, 1, "DOWN"), "KeyS": (0, 1, "DOWN"), "ArrowLeft": (-1, 0, "LEFT"), "KeyA": (-1, 0, "LEFT"), "ArrowRight": (1, 0, "RIGHT"), "KeyD": (1, 0, "RIGHT")}


def direction(code: Column) -> tuple[Column, Column, Column]:
    """dx, dy and facing of a key; 0, 0 and null for keys that don't move."""
    out = []
    for i, rest in ((0, F.lit(0)), (1, F.lit(0)), (2, F.lit(None).cast("string"))):
        arms = None
        for key, values in DIRECTIONS.items():
            arms = F.when(code == key, values[i]) if arms is None else arms.when(code == key, values[i])
        out.append(arms.otherwise(rest))
    return tuple(out)


def step(x: Column, y: Column, dx: Column, dy: Column) -> Column:
    """struct(x, y, moved): a wall is not entered."""
    free = tile(x + dx, y + dy) != "WALL"
    return F.struct(F.when(free, x + dx).otherwise(x).alias("x"), F.when(free, y + dy).otherwise(y).alias("y"), free.alias("moved"))


class Walk:
    """Walks of `dx` and `dy` inside the edge. A step clamps, and clamps compose; the steps taken hang on where a stretch is
    entered, so its summary is a table for each axis, from every place to where it ends and the steps between."""

    reads, gives, start = ["dx", "dy"], "x int, y int, steps long, moved boolean", (*START, 0)
    last = {"dx": MAP_W - 2, "dy": MAP_H - 2}

    def _along(self, axis: str, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        enter = np.arange(1, self.last[axis] + 1)[:, None]
        a, low, high = clamps(d, np.ones(len(d)), np.full(len(d), self.last[axis]))
        at = np.clip(enter + a, low, high)
        return at[:, -1], (np.diff(at, axis=1, prepend=enter) != 0).sum(1)

    def summary(self, rows: dict[str, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        return [self._along(axis, rows[axis]) for axis in self.reads]

    def then(self, first: list, second: list) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(end2[end1 - 1], n1 + n2[end1 - 1]) for (end1, n1), (end2, n2) in zip(first, second, strict=True)]

    def apply(self, summary: list, state: tuple[int, int, int]) -> tuple[int, int, int]:
        (x, nx), (y, ny) = ((int(end[at - 1]), int(n[at - 1])) for (end, n), at in zip(summary, state, strict=False))
        return x, y, state[2] + nx + ny

    def replay(self, rows: dict[str, np.ndarray], firsts: np.ndarray, state: tuple[int, int, int]) -> tuple[list[np.ndarray], tuple[int, int, int]]:
        places, taken = [], np.zeros(len(firsts), np.int64)
        for axis, start, now in zip(self.reads, START, state, strict=False):
            d = rows[axis].astype(np.int64)
            at = clamped(d, np.ones(len(d), np.int64), np.full(len(d), self.last[axis]), firsts, start, now)
            taken += at != before(at, firsts, start, now)
            places.append(at.astype(np.int32))
        so_far = taken.cumsum()
        none_yet = np.where(firsts, so_far - taken, -state[2])
        steps = so_far - np.maximum.accumulate(none_yet)
        return [*places, steps, taken > 0], (int(places[0][-1]), int(places[1][-1]), int(steps[-1]))


def walk_path(moves: DataFrame, key: str, order: list[str]) -> Ordered:
    """Every move with where it leads, the steps taken so far, whether this was one, and the tile. moves: key, order...,
    dx, dy and more; a move goes along one axis (one along both counts for each)."""
    return scan(ordered(moves, [key], order), Walk()).with_columns(tile=tile(F.col("x"), F.col("y")))


def walked(moves: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Where each key's walk from the start ends, and how many steps it took: the last row of its path."""
    path = walk_path(moves.select(key, *order, "dx", "dy"), key, order).result()
    last = path.groupBy(key).agg(F.max_by(F.struct("x", "y", "steps", "tile"), F.struct(*order)).alias("last"))
    return last.select(key, "last.*")


def encounters_along(path: Ordered, u: str) -> Ordered:
    """A path cut at its encounters: whether one begins at a move (a step onto grass and a low draw), how many
    there were, and the steps since the last one, or since the start."""
    hits = path.with_columns(meets=F.col("moved") & begins(F.col("tile"), F.col(u))).with_columns(_one=F.col("meets").cast("int"))
    counted = scan(scan(hits, Counter("_n", "_one")), LastSeen("_at", "steps", "meets"))
    return counted.with_columns(encounters=F.col("_n"), since=F.col("steps") - F.col("_at"))
