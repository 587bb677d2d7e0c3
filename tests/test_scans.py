"""Prefix scans give what a loop over all rows gives, wherever the rows are cut into tasks."""

import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skirmish.operators import battle, draws, movement, progression
from skirmish.operators.scans import STRETCH, Counter, LastSeen, clamps, numbered, ordered, scan
from skirmish.sources.dims import thresholds


@pytest.fixture
def cut(spark):
    """Small tables lie in several tasks too."""
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    for c, v in zip(old, ("false", "7", "50"), strict=True):
        spark.conf.set(c, v)
    yield spark
    for c, v in old.items():
        spark.conf.set(c, v)


def keyed(seed, n, keys=(None, 1, 2, 3, 4)):
    """Rows of several keys, two thirds of them of one, shuffled."""
    rng = random.Random(seed)
    rows = [(rng.choice(keys) if rng.random() < 0.3 else 2, i, rng.randint(-4, 4), rng.random()) for i in range(n)]
    rng.shuffle(rows)
    return rows


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(-20, 20), st.integers(0, 9)), min_size=1, max_size=70), st.integers(-30, 30))
def test_clamps_compose(maps, x):
    a, low, wide = (np.array(c) for c in zip(*maps, strict=True))
    together, want = clamps(a, low, low + wide), []
    now = x
    for i in range(len(maps)):
        now = min(max(now + a[i], low[i]), low[i] + wide[i])
        want.append(now)
    assert np.clip(x + together[0], together[1], together[2]).tolist() == want


@pytest.mark.parametrize("n", [1, 60, 900])
def test_counters_and_last_seen(cut, n):
    rows = keyed(n, n)
    df = cut.createDataFrame(rows, "k int, i int, d int, u double").withColumn("big", F.col("u") < 0.05)
    held = ordered(df, ["k"], ["i"])
    if n == 900:
        one = held.rows.where("k = 2").select(STRETCH).distinct().count()
        assert one >= 4, "a key of two thirds of the rows lies in several tasks"
    got = scan(scan(held, Counter("c", "d", 3, 0, 9)), LastSeen("at", "i", "big", -1)).result().collect()
    want = []
    for k, own in by_key(rows).items():
        c, at = 3, -1
        for _, i, d, u in own:
            c, c0, at0 = min(max(c + d, 0), 9), c, at
            at = i if u < 0.05 else at
            want.append((k, i, d, u, u < 0.05, c0, c, at0, at))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_numbers_of_a_whole_table(cut):
    rows = [(i * 37 % 1000, i % 3) for i in range(1000)]
    df = cut.createDataFrame(rows, "i int, n int")
    assert sorted((r["i"], r["place"]) for r in numbered(df, ["i"]).collect()) == [(i, i) for i in range(1000)]
    sums, want = 0, []
    for i, n in sorted(rows):
        want.append((i, n, sums))
        sums += n
    assert sorted(map(tuple, numbered(df, ["i"], "before", "n").collect())) == want


def test_walk_paths_and_encounters(cut):
    rows = [(k, i, d % 2 * (1 if d > 0 else -1), (1 - d % 2) * (1 if d > 0 else -1), u) for k, i, d, u in keyed(5, 1500) if d]
    got = movement.encounters_along(movement.walk_path(cut.createDataFrame(rows, "k int, i int, dx int, dy int, u double"), "k", ["i"]), "u").result()
    want = []
    for k, own in by_key(rows).items():
        x, y, steps, met, at = 3, 3, 0, 0, 0
        for _, i, dx, dy, u in own:
            moved = 1 <= x + dx <= 28 and 1 <= y + dy <= 18
            if moved:
                x, y, steps = x + dx, y + dy, steps + 1
            grass = 5 <= x <= 11 and 6 <= y <= 10 or 17 <= x <= 26 and 3 <= y <= 7
            meets = moved and grass and u < 0.12
            met, at = (met + 1, steps) if meets else (met, at)
            want.append((k, i, x, y, steps, moved, meets, met, steps - at))
    assert sorted(repr(tuple(r)) for r in got.select("k", "i", "x", "y", "steps", "moved", "meets", "encounters", "since").collect()) == sorted(map(repr, want))
    assert any(w[6] for w in want)


def test_throws_in_a_row(cut):
    rows = keyed(8, 400)
    df = cut.createDataFrame(rows, "k int, i int, d int, u double").withColumns({"hp": F.lit(5.0), "max_hp": F.lit(20.0)})
    got = battle.throws(df, "k", ["i"], "hp", "max_hp", "u", stock=40).select("k", "i", "balls_before", "balls", "result").collect()
    want = [(k, i, max(0, 40 - n), max(0, 39 - n), "REFUSED" if n >= 40 else "CAUGHT" if u < 0.25 + 15 / 20 * 0.55 else "BROKE_FREE") for k, own in by_key(rows).items() for n, (_, i, _, u) in enumerate(own)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_health_over_gains_and_hits(cut):
    rows = [(k, i, 5 * d if d > 2 else 0, -3 * d if d < 0 else 0) for k, i, d, _ in keyed(9, 1200)]
    got = progression.health(cut.createDataFrame(rows, "k int, i int, gain int, taken int"), "k", ["i"], "gain", "taken").result()
    needs, want = [n for *_, n in thresholds()], []
    for k, own in by_key(rows).items():
        level, exp, hp = 0, 0, 20
        for _, i, gain, hit in own:
            exp += gain
            while exp >= needs[level]:
                exp, level, hp = exp - needs[level], level + 1, 23 + 3 * level
            hp -= hit
            fainted = hp <= 0
            hp = 20 + 3 * level if fainted else hp
            want.append((k, i, 5 + level, 20 + 3 * level, hp, fainted))
    assert sorted(repr(tuple(r)) for r in got.select("k", "i", "level", "max_hp", "hp", "fainted").collect()) == sorted(map(repr, want))
    assert any(w[-1] for w in want) and max(w[2] for w in want) > 10


def test_draws_from_one_stream(cut):
    rows = [(i * 7 % 500, [0, 2, 1, 0, 0][i % 5]) for i in range(500)]
    stream = cut.createDataFrame([(p, p / 1000) for p in range(400)], "place long, u double")
    got = draws.with_draws(cut.createDataFrame(rows, "i int, n int"), ["i"], F.col("n"), stream, ["a", "b"])
    place, want = 0, []
    for i, n in sorted(rows):
        want.append((i, n, *[(place + j) / 1000 if j < n else None for j in range(2)]))
        place += n
    assert sorted(map(tuple, got.select("i", "n", "a", "b").collect())) == want
    with pytest.raises(Exception, match="too few draws"):
        draws.with_draws(cut.createDataFrame(rows, "i int, n int"), ["i"], F.col("n"), stream.where("place < 200"), ["a", "b"]).collect()


def test_empty(cut):
    none = cut.createDataFrame([], "k int, i int, dx int, dy int, gain int, taken int, u double")
    assert movement.encounters_along(movement.walk_path(none, "k", ["i"]), "u").result().count() == 0
    assert progression.health(none, "k", ["i"], "gain", "taken").result().count() == numbered(none, ["i"]).count() == 0


def test_no_window_over_a_table(cut):
    plan = numbered(cut.range(100).withColumn("n", F.lit(1)), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
