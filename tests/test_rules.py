"""Exact values of single rules, and what holds for all inputs."""

from itertools import pairwise

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skirmish.functions.damage import calculate_damage
from skirmish.functions.effectiveness import effectiveness, effectiveness_by_join
from skirmish.operators import movement, progression
from skirmish.operators.encounters import pick_by_table, weight_ranges
from skirmish.sources import dims
from skirmish.sources.derive import SESSION, derived
from skirmish.streaming.session import fresh, hero, run_batch, run_stream, session_step

BASE = {"level": 10.0, "atk_types": ["Fire"], "attack": 52.0, "sp_attack": 60.0, "status": None, "atk_ability": None, "def_types": ["Grass", "Poison"], "defense": 49.0, "sp_defense": 65.0, "def_ability": None, "type": "Fire", "category": "Special", "power": 40.0, "bonus": None, "weather": "NONE", "u_crit": 0.99, "u_roll": 0.99}
SCHEMA = "level double, atk_types array<string>, attack double, sp_attack double, status string, atk_ability string, def_types array<string>, defense double, sp_defense double, def_ability string, type string, category string, power double, bonus double, weather string, u_crit double, u_roll double"
GOLDEN = [
    ({}, 18, False, 2), ({"u_crit": 0.0, "u_roll": 0.0}, 20, True, 2), ({"weather": "SUN"}, 26, False, 2), ({"weather": "RAIN"}, 8, False, 2),
    ({"atk_ability": "Adaptability"}, 24, False, 2), ({"def_ability": "Thick Fat"}, 9, False, 2), ({"category": "Status"}, 0, False, 1),
    ({"type": "Normal", "def_types": ["Ghost"]}, 1, False, 0), ({"category": "Physical", "status": "BURN"}, 10, False, 2),
    ({"category": "Physical", "status": "BURN", "atk_ability": "Guts"}, 20, False, 2), ({"status": "BURN"}, 18, False, 2),
    ({"bonus": 3.0}, 26, True, 2), ({"bonus": 9.0}, 26, True, 2), ({"def_types": []}, 9, False, 1),
    ({"type": "Electric", "def_types": ["Water", "Flying"]}, 24, False, 4), ({"def_types": ["Grass", "Grass"]}, 36, False, 4),
]


def damages(spark, cases):
    rows = [(i, *(BASE | c).values()) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, f"i int, {SCHEMA}")
    c = F.col
    attacker = {"level": c("level"), "types": c("atk_types"), "attack": c("attack"), "sp_attack": c("sp_attack"), "status": c("status"), "ability": c("atk_ability")}
    defender = {"types": c("def_types"), "defense": c("defense"), "sp_defense": c("sp_defense"), "ability": c("def_ability")}
    move = {"type": c("type"), "category": c("category"), "base_power": c("power"), "crit_bonus": c("bonus")}
    out = df.select("i", calculate_damage(attacker, defender, move, c("weather"), c("u_crit"), c("u_roll")).alias("r")).select("i", "r.*")
    return [tuple(r)[1:] for r in out.orderBy("i").collect()]


def test_golden_damage(spark):
    assert damages(spark, [c for c, *_ in GOLDEN]) == [tuple(r) for _, *r in GOLDEN]


def test_critical_stages(spark):
    cases = [{"bonus": b, "u_crit": u} for b, u in ((0.0, 1 / 24), (0.0, 0.0416), (1.0, 0.125), (1.0, 0.1249), (2.0, 0.5), (2.0, 0.4999), (-1.0, 0.0), (0.5, 0.0), (3.0, 0.9999), (float("nan"), 0.0))]
    assert [r[1] for r in damages(spark, cases)] == [False, True, False, True, False, True, False, False, True, False]


def test_no_defense(spark):
    inf, nan, still = damages(spark, [{"sp_defense": 0.0}, {"sp_defense": 0.0, "sp_attack": 0.0}, {"sp_defense": 0.0, "category": "Status"}])
    assert inf[0] == float("inf") and nan[0] != nan[0] and still[0] == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.fixed_dictionaries({"level": st.floats(1, 100), "attack": st.floats(1, 500), "sp_defense": st.floats(1, 500), "type": st.sampled_from(dims.TYPES), "category": st.sampled_from(["Physical", "Special", "Status"]), "def_types": st.lists(st.sampled_from(dims.TYPES), max_size=3), "u_roll": st.floats(0, 0.999)}), min_size=1, max_size=30))
def test_damage_is_at_least_one(spark, cases):
    for case, (damage, _, _) in zip(cases, damages(spark, cases), strict=True):
        assert damage == 0 if case["category"] == "Status" else damage >= 1 and damage == int(damage)


def test_chart(spark):
    cells = dims.chart_cells()
    assert len(cells) == len({c[:2] for c in cells}) == 120
    assert [sum(m == v for *_, m in cells) for v in (0.5, 2.0, 0.0)] == [61, 51, 8]
    rows = spark.createDataFrame([("Electric", ["Water", "Flying"]), ("Normal", ["Ghost"]), ("Fire", []), ("Fire", None), ("Fire", ["Grass", "Ice"]), ("Fire", ["Ice", "Grass"])], "m string, d array<string>")
    assert [r[0] for r in rows.select(effectiveness(F.col("m"), F.col("d"))).collect()] == [4, 0, 1, 1, 4, 4]


def test_tiles(spark):
    assert {r["tile"]: r["count"] for r in dims.tile_map(spark).groupBy("tile").count().collect()} == {"WALL": 96, "GRASS": 85, "GROUND": 419}


def test_levels(spark):
    needs = [n for *_, n in dims.thresholds()]
    assert needs[:13] == [20, 26, 33, 42, 54, 70, 91, 118, 153, 198, 257, 334, 434] and all(a < b for a, b in pairwise(needs))
    gains = [7, 14, 19, 21, 200, 35]
    level, exp, want = 0, 0, []
    for g in gains:  # level by level
        exp += g
        while exp >= needs[level]:
            exp, level = exp - needs[level], level + 1
        want.append((5 + level, 20 + 3 * level, 11 + level, 10 + level, exp, needs[level]))
    assert [tuple(hero(fresh() | {"total": sum(gains[: i + 1])}).values()) for i in range(len(gains))] == want
    df = spark.createDataFrame(list(enumerate(gains)), "i int, amount int").withColumn("k", F.lit(1))
    got = progression.running(df, "k", ["i"], "amount").orderBy("i")
    assert [tuple(r) for r in got.select("level", "max_hp", "atk", "def", "exp", "to_next").collect()] == want


def test_levels_go_as_far_as_a_long(spark):
    def at(total):
        return progression.final(spark.createDataFrame([(1, total)], "k int, amount long"), "k", "amount").first()

    for total in (10**12, dims.experience_limit() - 1):
        r = at(total)
        assert 0 <= r["exp"] < r["to_next"] and r["level"] > 85
    with pytest.raises(Exception, match="more experience"):
        at(dims.experience_limit())


def test_pick_by_table(spark):
    import numpy as np

    rows = spark.createDataFrame([(i, u) for i, u in enumerate([0.0, 1e-9, 0.3, 0.5, 0.7, 0.999999])], "i int, u double")
    for weights in ([0, 5], [5, 0, 5], [1], [0, 0, 3, 0], [0, 0], [2] * 500 + [0] * 7 + [5] * 300):
        table = spark.createDataFrame(list(enumerate(weights)), "ord int, weight int")
        total, running = sum(weights), np.cumsum(weights)
        want = [(i, next(o for o, below in enumerate(running) if u * total <= below)) for i, u in enumerate([0.0, 1e-9, 0.3, 0.5, 0.7, 0.999999])]
        for limit in (10_000, 0):
            assert sorted(map(tuple, pick_by_table(rows, table, "u", limit).select("i", "ord").collect())) == want, (weights[:5], limit)
        parted = weight_ranges(table, 3).orderBy("ord").collect()
        assert [(r["ord"], r["_high"]) for r in parted] == [(o, int(running[o])) for o, w in enumerate(weights) if w or not o]


def test_effectiveness_of_repeated_keys(spark):
    rows = spark.createDataFrame([(1, "Electric", ["Water", "Flying"]), (1, "Normal", ["Ghost"]), (None, "Fire", []), (2, "Fire", None)], "mult int, atk string, def array<string>")
    assert sorted(map(tuple, effectiveness_by_join(rows, "mult", "atk", "def").collect()), key=repr) == [(1, 0.0), (1, 4.0), (2, 1.0), (None, 1.0)]


def test_walks_are_brute_force(spark):
    axis = [(1, 0), (-1, 0), (0, 1), (0, -1), (0, 0)]
    moves = [(k if k else None, i, *axis[(i * i + 3 * k + i // 9) % 5 if k % 2 else (k + i // 40) % 4]) for k in range(8) for i in range(90)]
    want = {}
    for k, _, dx, dy in moves:
        x, y, n = want.get(k, (3, 3, 0))
        went = 1 <= x + dx <= 28 and 1 <= y + dy <= 18
        want[k] = (x + dx, y + dy, n + (dx != 0 or dy != 0)) if went else (x, y, n)
    got = movement.walked(spark.createDataFrame(moves, "k int, i int, dx int, dy int").repartition(3), "k", ["i"])
    assert {r["k"]: (r["x"], r["y"], r["steps"]) for r in got.collect()} == want


def test_walk_never_enters_a_wall(spark):
    moves = spark.createDataFrame([(k, i, (i * 7 + k) % 3 - 1, 0 if i % 2 else (i + k) % 3 - 1) for k in range(20) for i in range(60)], "k int, i int, dx int, dy int")
    assert movement.walked(moves, "k", ["i"]).where("tile = 'WALL'").count() == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k int, i int, dx int, dy int, amount int")
    assert movement.walked(none, "k", ["i"]).count() == progression.final(none, "k", "amount").count() == 0


def frame(code, **draws):
    return {"code": code, "dt": 16.0, "event_id": 0, "ts": 0} | {u: 0.5 for u in ("u_enc", "u_pick", "u_level", "u_hit", "u_back", "u_catch")} | draws


def after(state, *frames):
    for f in frames:
        state = session_step(state, f)
    return state


def test_session_rules():
    state = after(fresh(), frame("ArrowUp"))
    assert state["scene"] == "TITLE" and (state["x"], state["y"], state["facing"]) == (3, 3, "DOWN")
    state = after(state, *map(frame, ("Enter", *["KeyD"] * 2, *["KeyS"] * 2)))
    assert (state["scene"], state["x"], state["y"], state["steps"], state["facing"], state["log"]) == ("OVERWORLD", 5, 5, 4, "DOWN", None)
    state = after(state, frame("ArrowDown", u_enc=0.1))
    assert state["scene"] == "BATTLE" and state["wild"] == {"species": "Pidgey", "level": 3, "max_hp": 21, "hp": 21, "atk": 11, "def": 11}
    assert state["log"] == "A wild Pokémon appeared!" and state["message"] == ""
    state = after(state, frame("Digit2 Digit1"))
    assert state["wild"]["hp"] == 17 and state["balls"] == 5 and state["log"].endswith("Pidgey hit back for 4.")
    state = after(state, frame("Digit2", u_catch=0.99))
    assert state["balls"] == 4 and state["hp"] == 16 and state["log"] == "Pidgey broke free!" and state["message"] == ""
    state = after(state, *[frame("Digit1", u_hit=0.99)] * 4)
    # The level gained heals, and the message's scene is overridden at once.
    assert state["scene"] == "OVERWORLD" and hero(state)["level"] == 6 and state["hp"] == 23 and hero(state)["exp"] == 1 and state["wild"] is state["log"] is None
    assert state["message"] == "You defeated Pidgey! +21 EXP"
    rattata = {"species": "Rattata", "level": 2, "max_hp": 18, "hp": 18, "atk": 12, "def": 9}
    battle = state | {"balls": 0, "scene": "BATTLE", "wild": rattata, "log": "-"}
    assert after(battle, frame("Digit2"))["log"] == "No Poké Balls left!" and after(battle, frame("Digit2"))["scene"] == "BATTLE"
    assert after(battle, frame("KeyX"))["message"] == "Got away safely!" and after(battle, frame("KeyX"))["scene"] == "OVERWORLD"
    fainted = after(battle | {"hp": 1}, frame("Digit1"))
    assert fainted["message"].startswith("You blacked out") and fainted["hp"] == 23 and fainted["wild"] is None
    assert after(battle | {"balls": 1}, frame("Digit2", u_catch=0.2))["message"] == "Gotcha! Rattata was caught!"
    wall = after(fresh() | {"scene": "OVERWORLD", "x": 1}, frame("KeyA"))
    assert (wall["x"], wall["steps"], wall["facing"]) == (1, 0, "LEFT")


def test_message_scene_counts_down():
    state = after(fresh() | {"scene": "MESSAGE", "timer": 20.0}, frame("KeyD"))
    assert state["scene"] == "MESSAGE" and after(state, frame("KeyD"))["scene"] == "OVERWORLD"


def test_sessions_without_a_key_and_of_many_batches(spark):
    frames = derived(spark, "/root/testdata/sf0.001", SESSION)
    want = sorted(map(repr, run_batch(frames).collect()))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(repr, run_batch(frames).collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    none = run_batch(frames.where("user_id < 3").withColumn("user_id", F.lit(None).cast("long"))).collect()
    assert len(none) == frames.where("user_id < 3").count() and {r["user_id"] for r in none} == {None}
    assert run_batch(frames.limit(0)).count() == 0


def test_stream_is_the_batch(spark, tmp_path):
    frames = derived(spark, "/root/testdata/sf0.001", SESSION).where("user_id < 8")
    # Two files in order of time: sessions go on over the micro-batches.
    times = sorted(r["ts"] for r in frames.select("ts").collect())
    middle = F.lit(times[len(times) // 2]).cast("timestamp_ntz")
    for i, part in enumerate((F.col("ts") <= middle, F.col("ts") > middle)):
        frames.where(part).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    source = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    running = run_stream(source).writeStream.format("memory").queryName("sessions").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    running.awaitTermination(240)
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(spark.table("sessions")) == key(run_batch(frames))


def test_stream_forgets_silent_sessions(spark, tmp_path):
    """The processor takes a lifetime for its state; a long one changes nothing."""
    import time

    frames = derived(spark, "/root/testdata/sf0.001", SESSION).where("user_id < 3")
    frames.coalesce(1).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(frames.schema).parquet(f"{tmp_path}/in")
    running = run_stream(source, ttl_ms=3_600_000).writeStream.format("memory").queryName("kept").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").start()
    want, until = frames.count(), time.monotonic() + 90
    while spark.table("kept").count() < want and time.monotonic() < until:
        time.sleep(1)
    running.stop()
    assert sorted(map(repr, spark.table("kept").collect())) == sorted(map(repr, run_batch(frames).collect()))


def rows_of(running, table, spark, enough, seconds=120):
    """The rows of a memory table once there are enough of them."""
    import time

    until = time.monotonic() + seconds
    while spark.table(table).count() < enough and time.monotonic() < until:
        time.sleep(0.5)
    running.stop()
    return spark.table(table).collect()


def test_message_ends_without_a_frame(spark, tmp_path):
    """The timer of a message runs out in processing time; the row that it gives has no event."""
    begin = fresh() | {"scene": "MESSAGE", "message": "Hello", "timer": 900.0}
    frames = derived(spark, "/root/testdata/sf0.001", SESSION).where("event_id IN (3, 500)").withColumn("user_id", F.col("event_id"))
    frames.coalesce(1).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(frames.schema).parquet(f"{tmp_path}/in")
    running = run_stream(source, timers=True, begin=begin).writeStream.format("memory").queryName("timed").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").start()
    got = rows_of(running, "timed", spark, 4)
    assert sorted((r["user_id"], r["scene"], r["timer"]) for r in got if r["event_id"] is not None) == [(3, "MESSAGE", 887.0), (500, "MESSAGE", 890.0)]
    ended = [r for r in got if r["event_id"] is None]
    assert sorted((r["user_id"], r["scene"], r["timer"], r["message"]) for r in ended) == [(3, "OVERWORLD", 0.0, "Hello"), (500, "OVERWORLD", 0.0, "Hello")]


def test_late_frames_are_taken_in_order(spark, tmp_path):
    """Frames that come shuffled over three micro-batches give what the batch gives, once the watermark has passed them."""
    frames = derived(spark, "/root/testdata/sf0.001", SESSION).where("user_id < 4").withColumn("ts", F.col("ts").cast("timestamp"))
    for i in range(3):
        frames.where((F.col("event_id") * 7 % 3) == i).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    late = frames.limit(1).withColumns({"user_id": F.lit(99).cast("long"), "ts": F.expr("ts + INTERVAL 400 DAYS")})
    late.coalesce(1).write.parquet(f"{tmp_path}/in/3")
    source = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    running = run_stream(source, late="40 days").writeStream.format("memory").queryName("shuffled").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").start()
    got = rows_of(running, "shuffled", spark, frames.count())
    assert sorted(map(repr, got)) == sorted(map(repr, run_batch(frames).collect()))
    with pytest.raises(ValueError, match="event time"):
        run_stream(source, ttl_ms=5, late="1 day")


def test_pressed_keys(spark):
    from skirmish.operators.frames import pressed

    rows = [(1, 1, 1, "A", "down"), (1, 1, 2, "B", "down"), (1, 1, 3, "A", "up"), (1, 2, 4, "A", "up"), (1, 2, 5, "A", "down"), (1, 3, 6, "B", "up"), (None, 1, 7, "C", "down"), (1, 4, 8, None, "down"), (1, 4, 9, "D", "down"), (1, 4, 10, "D", "held"), (1, 4, 11, "A", "down")]
    got = pressed(spark.createDataFrame(rows, "s int, f int, n int, code string, kind string"), "s", "f", ["n"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 1, 3, "B"), (1, 2, 5, "A"), (1, 3, 6, ""), (None, 1, 7, "C"), (1, 4, 11, "A D")], key=repr)
