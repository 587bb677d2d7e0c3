"""Experience, levels and health. The thresholds depend on the level alone, so a level follows from total experience: no loop."""

from __future__ import annotations

from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.operators.scans import Counter, Ordered, ordered, scan
from skirmish.sources.dims import STARTER, experience_limit, thresholds

AWARD = 7  # fixed value: experience for each level of the defeated


def award(wild_level: Column) -> Column:
    return wild_level * AWARD


def levels_gained(total: Column) -> Column:
    """The number of thresholds that a total reaches, by halving: a tree of comparisons as deep as the table's logarithm. Levels
    go as far as sums of thresholds fit a long; a total beyond that is an error."""
    sums = [s for _, s, _ in thresholds()]

    def between(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last + 1) // 2
        return F.when(total < F.lit(sums[middle]), between(first, middle - 1)).otherwise(between(middle, last))

    beyond = F.raise_error(F.lit("more experience than levels are known for")).cast("int")
    return F.when(total >= experience_limit(), beyond).otherwise(between(0, len(sums) - 1))


#: The columns of levelled().
STATE = ["level", "max_hp", "atk", "def", "exp", "to_next"]


def levelled(rows: DataFrame, total: str) -> DataFrame:
    """The rows with the starter's STATE after `total` experience in all. The search is done once a row, in a projection of its own."""
    gained, total = F.col("_gained"), F.col(total)
    sums, needs = (F.lit(list(column)) for column in list(zip(*thresholds(), strict=True))[1:])
    return rows.withColumn("_gained", levels_gained(total)).withColumns({
        "level": (F.lit(STARTER["level"]) + gained).cast("long"),
        "max_hp": (F.lit(STARTER["max_hp"]) + 3 * gained).cast("long"),
        "atk": (F.lit(STARTER["atk"]) + gained).cast("long"),
        "def": (F.lit(STARTER["def"]) + gained).cast("long"),
        "exp": (total - F.get(sums, gained)).cast("long"),
        "to_next": F.get(needs, gained).cast("long"),
    }).drop("_gained")


def running(gains: DataFrame, key: str, order: list[str], amount: str) -> DataFrame:
    """Each gain with the state after it."""
    held = scan(ordered(gains, [key], order), Counter("total_exp", amount))
    return levelled(held.result().drop("total_exp_before"), "total_exp")


def final(gains: DataFrame, key: str, amount: str) -> DataFrame:
    """The state after all gains of each key; sums combine before they shuffle."""
    return levelled(gains.groupBy(key).agg(F.sum(amount).alias("total_exp")), "total_exp")


class Health:
    """Health under hits: `heals` sets it to `top`, a `hit` takes from it, and who has none left is healed to `top` at once.
    What a stretch does is a number, once it heals, and before that a table from every health that may enter."""

    reads, gives, start = ["hit", "top", "heals"], "hp long, fainted boolean", STARTER["hp"]

    def summary(self, rows: dict[str, np.ndarray]) -> np.ndarray | int:
        state: Any = np.arange(1, int(rows["top"][0]) + 1)
        for hit, top, heals in zip(*(rows[c].tolist() for c in self.reads), strict=True):
            state = top if heals else state
            if isinstance(state, int):
                state = state - hit if state > hit else top
            else:
                state = np.where(state > hit, state - hit, top)
        return state

    def then(self, first: np.ndarray | int, second: np.ndarray | int) -> np.ndarray | int:
        if isinstance(second, int):
            return second
        return self.apply(second, first) if isinstance(first, int) else second[first - 1]

    def apply(self, summary: np.ndarray | int, state: int) -> int:
        return summary if isinstance(summary, int) else int(summary[state - 1])

    def replay(self, rows: dict[str, np.ndarray], firsts: np.ndarray, state: int) -> tuple[list[np.ndarray], int]:
        hp, fainted = [], []
        for first, hit, top, heals in zip(firsts.tolist(), *(rows[c].tolist() for c in self.reads), strict=True):
            if first:
                state = self.start
            state = top if heals else state
            faints = hit >= state
            state = top if faints else state - hit
            hp.append(state)
            fainted.append(faints)
        return [np.array(hp, np.int64), np.array(fainted, bool)], state


def health(events: DataFrame, key: str, order: list[str], gain: str, hit: str) -> Ordered:
    """Each gain of experience and each hit (whole numbers, the other 0) with level, max_hp, hp and whether the hero fainted. A level
    gained heals, and so does fainting; hits come after gains where a row has both."""
    held = scan(ordered(events, [key], order), Counter("total_exp", gain))
    grown = levels_gained(F.col("total_exp")) > levels_gained(F.col("total_exp_before"))
    rows = levelled(held.rows, "total_exp").withColumns({"heals": grown, "top": F.col("max_hp"), "hit": F.col(hit).cast("long")})
    return scan(Ordered(rows.drop("total_exp_before"), held.key), Health())
