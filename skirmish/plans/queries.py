"""Each rule as a query over inputs derived from `events`, with SQL of its own that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skirmish.functions import damage, display
from skirmish.functions.effectiveness import effectiveness, effectiveness_by_join
from skirmish.operators import battle, draws, encounters, frames, movement, progression
from skirmish.sources import dims
from skirmish.sources.derive import BATTLE, KEYS, SESSION, derived, draw, pick, sql
from skirmish.streaming.session import fresh, run_batch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return keep


# ---- inputs and SQL shared by several queries

_C = F.col
# The type chart's cells that aren't 1, for SQL; and below it the wild encounters with running weights.
CHART_ROWS = """
    ('Normal', 'Rock', 0.5), ('Normal', 'Ghost', 0.0), ('Normal', 'Steel', 0.5),
    ('Fire', 'Fire', 0.5), ('Fire', 'Water', 0.5), ('Fire', 'Grass', 2.0), ('Fire', 'Ice', 2.0), ('Fire', 'Bug', 2.0), ('Fire', 'Rock', 0.5), ('Fire', 'Dragon', 0.5), ('Fire', 'Steel', 2.0),
    ('Water', 'Fire', 2.0), ('Water', 'Water', 0.5), ('Water', 'Grass', 0.5), ('Water', 'Ground', 2.0), ('Water', 'Rock', 2.0), ('Water', 'Dragon', 0.5),
    ('Grass', 'Fire', 0.5), ('Grass', 'Water', 2.0), ('Grass', 'Grass', 0.5), ('Grass', 'Poison', 0.5), ('Grass', 'Ground', 2.0), ('Grass', 'Flying', 0.5), ('Grass', 'Bug', 0.5), ('Grass', 'Rock', 2.0), ('Grass', 'Dragon', 0.5), ('Grass', 'Steel', 0.5),
    ('Electric', 'Water', 2.0), ('Electric', 'Grass', 0.5), ('Electric', 'Electric', 0.5), ('Electric', 'Ground', 0.0), ('Electric', 'Flying', 2.0), ('Electric', 'Dragon', 0.5),
    ('Ice', 'Fire', 0.5), ('Ice', 'Water', 0.5), ('Ice', 'Grass', 2.0), ('Ice', 'Ice', 0.5), ('Ice', 'Ground', 2.0), ('Ice', 'Flying', 2.0), ('Ice', 'Dragon', 2.0), ('Ice', 'Steel', 0.5),
    ('Fighting', 'Normal', 2.0), ('Fighting', 'Ice', 2.0), ('Fighting', 'Poison', 0.5), ('Fighting', 'Flying', 0.5), ('Fighting', 'Psychic', 0.5), ('Fighting', 'Bug', 0.5), ('Fighting', 'Rock', 2.0), ('Fighting', 'Ghost', 0.0), ('Fighting', 'Dark', 2.0), ('Fighting', 'Steel', 2.0), ('Fighting', 'Fairy', 0.5),
    ('Poison', 'Grass', 2.0), ('Poison', 'Poison', 0.5), ('Poison', 'Ground', 0.5), ('Poison', 'Rock', 0.5), ('Poison', 'Ghost', 0.5), ('Poison', 'Steel', 0.0), ('Poison', 'Fairy', 2.0),
    ('Ground', 'Fire', 2.0), ('Ground', 'Grass', 0.5), ('Ground', 'Electric', 2.0), ('Ground', 'Poison', 2.0), ('Ground', 'Flying', 0.0), ('Ground', 'Bug', 0.5), ('Ground', 'Rock', 2.0), ('Ground', 'Steel', 2.0),
    ('Flying', 'Grass', 2.0), ('Flying', 'Electric', 0.5), ('Flying', 'Fighting', 2.0), ('Flying', 'Bug', 2.0), ('Flying', 'Rock', 0.5), ('Flying', 'Steel', 0.5),
    ('Psychic', 'Fighting', 2.0), ('Psychic', 'Poison', 2.0), ('Psychic', 'Psychic', 0.5), ('Psychic', 'Dark', 0.0), ('Psychic', 'Steel', 0.5),
    ('Bug', 'Fire', 0.5), ('Bug', 'Grass', 2.0), ('Bug', 'Fighting', 0.5), ('Bug', 'Poison', 0.5), ('Bug', 'Flying', 0.5), ('Bug', 'Psychic', 2.0), ('Bug', 'Ghost', 0.5), ('Bug', 'Dark', 2.0), ('Bug', 'Steel', 0.5), ('Bug', 'Fairy', 0.5),
    ('Rock', 'Fire', 2.0), ('Rock', 'Ice', 2.0), ('Rock', 'Fighting', 0.5), ('Rock', 'Ground', 0.5), ('Rock', 'Flying', 2.0), ('Rock', 'Bug', 2.0), ('Rock', 'Steel', 0.5),
    ('Ghost', 'Normal', 0.0), ('Ghost', 'Psychic', 2.0), ('Ghost', 'Ghost', 2.0), ('Ghost', 'Dark', 0.5),
    ('Dragon', 'Dragon', 2.0), ('Dragon', 'Steel', 0.5), ('Dragon', 'Fairy', 0.0),
    ('Dark', 'Fighting', 0.5), ('Dark', 'Psychic', 2.0), ('Dark', 'Ghost', 2.0), ('Dark', 'Dark', 0.5), ('Dark', 'Fairy', 0.5),
    ('Steel', 'Fire', 0.5), ('Steel', 'Water', 0.5), ('Steel', 'Electric', 0.5), ('Steel', 'Ice', 2.0), ('Steel', 'Rock', 2.0), ('Steel', 'Steel', 0.5), ('Steel', 'Fairy', 2.0),
    ('Fairy', 'Fire', 0.5), ('Fairy', 'Fighting', 2.0), ('Fairy', 'Poison', 0.5), ('Fairy', 'Dragon', 2.0), ('Fairy', 'Dark', 2.0), ('Fairy', 'Steel', 0.5)
"""
CHART = f"chart(atk, def, mult) AS (SELECT a, d, CAST(m AS DOUBLE) FROM (VALUES {CHART_ROWS}) v(a, d, m))"
WILD_ROWS = "wild_rows(ord, species, low, high, below, hp, atk, def, kind) AS (VALUES (0, 'Pidgey', 2, 4, 55, 18, 10, 10, 'Normal'), (1, 'Rattata', 2, 4, 90, 16, 11, 8, 'Normal'), (2, 'Pikachu', 3, 5, 100, 17, 12, 8, 'Electric'))"
B = f"b AS ({sql(BATTLE)})"
S = f"s AS ({sql(SESSION)})"
# Stages of the damage rule in SQL, each reading d0 to d8 of the one before.
STAGES = f"""{CHART}, {B},
 e AS (SELECT b.*, coalesce(c1.mult, 1) * coalesce(c2.mult, 1) AS eff FROM b
       LEFT JOIN chart c1 ON c1.atk = move_type AND c1.def = def_type1
       LEFT JOIN chart c2 ON c2.atk = move_type AND c2.def = def_type2),
 p0 AS (SELECT *, floor((2e0 * atk_level / 5e0 + 2e0) * base_power
            * (CASE category WHEN 'Physical' THEN attack / defense ELSE sp_attack / sp_defense END) / 50e0) + 2e0 AS d0,
        CASE WHEN crit_bonus IS NULL THEN 0 WHEN crit_bonus > 3 THEN 3 ELSE crit_bonus END AS crit_stage FROM e),
 p1 AS (SELECT *, CASE WHEN weather = 'SUN' AND move_type = 'Fire' OR weather = 'RAIN' AND move_type = 'Water' THEN floor(d0 * 1.5e0)
                       WHEN weather = 'SUN' AND move_type = 'Water' OR weather = 'RAIN' AND move_type = 'Fire' THEN floor(d0 * 0.5e0) ELSE d0 END AS d1,
        CASE crit_stage WHEN 0 THEN u_crit < 1e0 / 24 WHEN 1 THEN u_crit < 0.125e0 WHEN 2 THEN u_crit < 0.5e0 WHEN 3 THEN u_crit < 1 ELSE false END AS crit FROM p0),
 p2 AS (SELECT *, CASE WHEN crit THEN floor(d1 * 1.5e0) ELSE d1 END AS d2 FROM p1),
 p3 AS (SELECT *, floor(d2 * (floor(u_roll * 16 + 85) / 100)) AS d3 FROM p2),
 p4 AS (SELECT *, CASE WHEN move_type = atk_type1 OR move_type IS NOT DISTINCT FROM atk_type2 THEN floor(d3 * (CASE WHEN atk_ability = 'Adaptability' THEN 2e0 ELSE 1.5e0 END)) ELSE d3 END AS d4 FROM p3),
 p5 AS (SELECT *, floor(d4 * eff) AS d5 FROM p4),
 p6 AS (SELECT *, CASE WHEN atk_status = 'BURN' AND category = 'Physical' AND atk_ability IS DISTINCT FROM 'Guts' THEN floor(d5 * 0.5e0) ELSE d5 END AS d6 FROM p5),
 p7 AS (SELECT *, CASE WHEN def_ability = 'Thick Fat' AND move_type IN ('Fire', 'Ice') THEN floor(d6 * 0.5e0) ELSE d6 END AS d7 FROM p6)"""
WILD = f"""{WILD_ROWS}, {S},
 w AS (SELECT s.*, r.species, CAST(floor(u_level * (high - low + 1)) AS BIGINT) + low AS level, hp, atk, def, kind FROM s
       JOIN wild_rows r ON u_pick * 100 <= below AND NOT EXISTS (SELECT 1 FROM wild_rows q WHERE q.ord < r.ord AND u_pick * 100 <= q.below))"""
SIMPLE = "greatest(1e0, floor((floor(4e0 * {power} * (CAST({atk} AS DOUBLE) / {df}) / 50e0) + 2e0) * ((floor({u} * 16) + 85) / 100e0)))"
TILE = "CASE WHEN {x} IN (0, 29) OR {y} IN (0, 19) THEN 'WALL' WHEN ({x} BETWEEN 5 AND 11 AND {y} BETWEEN 6 AND 10) OR ({x} BETWEEN 17 AND 26 AND {y} BETWEEN 3 AND 7) THEN 'GRASS' ELSE 'GROUND' END"
THRESHOLDS = """RECURSIVE need(k, total, next) AS (
   SELECT 0, CAST(0 AS BIGINT), CAST(20 AS BIGINT) UNION ALL
   SELECT k + 1, total + next, CAST(floor(next * 1.3e0) AS BIGINT) FROM need WHERE k < 140)"""
AMOUNT = "(2 + event_id % 4) * 7"
WALK = "CASE (event_id * 7) % 5 {arms} END"
DX, DY = (WALK.format(arms=" ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(vs))) for vs in ([1, 0, -1, 0, 1], [0, 1, 0, -1, 0]))
PLACE = "CAST(event_id % 28 + 1 AS INT)", "CAST(event_id * 3 % 18 + 1 AS INT)"
HP = "CAST(event_id % 21 AS DOUBLE)"
GAIN, HIT = f"CASE event_id % 4 WHEN 0 THEN {AMOUNT} ELSE 0 END", "CASE event_id % 4 WHEN 0 THEN 0 ELSE 2 + event_id % 5 END"
# Every move of every walk, one by one.
WALK_STEPS = f"""m AS (SELECT *, {DX} AS dx, {DY} AS dy, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
   w(user_id, event_id, i, x, y, steps, moved) AS (
     SELECT DISTINCT user_id, CAST(NULL AS BIGINT), CAST(0 AS BIGINT), 3, 3, CAST(0 AS BIGINT), false FROM m UNION ALL
     SELECT w.user_id, m.event_id, m.i, CAST(least(greatest(w.x + dx, 1), 28) AS INT), CAST(least(greatest(w.y + dy, 1), 18) AS INT),
            w.steps + CASE WHEN w.x + dx BETWEEN 1 AND 28 AND w.y + dy BETWEEN 1 AND 18 THEN 1 ELSE 0 END, w.x + dx BETWEEN 1 AND 28 AND w.y + dy BETWEEN 1 AND 18
     FROM w JOIN m ON m.user_id = w.user_id AND m.i = w.i + 1),
   path AS (SELECT *, {TILE.format(x="x", y="y")} AS tile FROM w WHERE i > 0)"""


def _types(first: str, second: str) -> Column:
    """One or two types; a second type is null where there is none."""
    return F.array_compact(F.array(first, second))


def _battle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, BATTLE).withColumn("atk_types", _types("atk_type1", "atk_type2")).withColumn("def_types", _types("def_type1", "def_type2"))


def _parts() -> dict[str, Column]:
    physical = _C("category") == "Physical"
    base = damage.base_damage(_C("atk_level"), _C("base_power"), F.when(physical, _C("attack")).otherwise(_C("sp_attack")), F.when(physical, _C("defense")).otherwise(_C("sp_defense")))
    d1 = damage.stage(base, damage.weather_factor(_C("weather"), _C("move_type")))
    critical = damage.is_critical(_C("crit_bonus"), _C("u_crit"))
    d2 = damage.stage(d1, damage.critical_factor(critical))
    d3 = damage.stage(d2, damage.roll_factor(_C("u_roll")))
    d4 = damage.stage(d3, damage.same_type_factor(_C("atk_types"), _C("move_type"), _C("atk_ability")))
    d5 = damage.stage(d4, effectiveness(_C("move_type"), _C("def_types")))
    d6 = damage.stage(d5, damage.burn_factor(_C("atk_status"), _C("category"), _C("atk_ability")))
    d7 = damage.stage(d6, damage.defender_factor(_C("def_ability"), _C("move_type")))
    return {"d0": base, "d1": d1, "crit": critical, "d2": d2, "d3": d3, "d4": d4, "d5": d5, "d6": d6, "d7": d7}


def _stage(spark: SparkSession, sf_dir: str, **columns: str) -> DataFrame:
    parts = _parts()
    return _battle(spark, sf_dir).select("event_id", *[parts[p].alias(n) for n, p in columns.items()])


def _damages(battles: DataFrame) -> DataFrame:
    attacker = {"level": _C("atk_level"), "types": _C("atk_types"), "attack": _C("attack"), "sp_attack": _C("sp_attack"), "status": _C("atk_status"), "ability": _C("atk_ability")}
    defender = {"types": _C("def_types"), "defense": _C("defense"), "sp_defense": _C("sp_defense"), "ability": _C("def_ability")}
    move = {"type": _C("move_type"), "category": _C("category"), "base_power": _C("base_power"), "crit_bonus": _C("crit_bonus")}
    result = damage.calculate_damage(attacker, defender, move, _C("weather"), _C("u_crit"), _C("u_roll"))
    return battles.select("event_id", result.alias("r")).select("event_id", "r.*")


# ---- type chart

_MET = "met AS (SELECT move_type, def_type1, count(*) AS n FROM b GROUP BY ALL)"


def _met(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a move's type met a defender's first type; 324 rows at most."""
    return _battle(spark, sf_dir).groupBy("move_type", "def_type1").agg(F.count("*").alias("n"))


@query(f"WITH {CHART}, {B}, {_MET} SELECT atk, def, mult, coalesce(n, 0) AS n FROM chart LEFT JOIN met ON move_type = atk AND def_type1 = def")
def type_chart_long(spark, sf_dir):
    """The chart's cells and how often each was met."""
    met = _met(spark, sf_dir).select(_C("move_type").alias("atk"), _C("def_type1").alias("def"), "n")
    return dims.type_chart(spark).join(met, ["atk", "def"], "left").select("atk", "def", "mult", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"WITH {CHART}, {B}, {_MET} SELECT move_type, def_type1 AS def_type, coalesce(mult, CAST(1 AS DOUBLE)) AS effectiveness, n FROM met LEFT JOIN chart ON atk = move_type AND def = def_type1")
def type_effectiveness_mono(spark, sf_dir):
    """Pairs of types that met, with their factor and number."""
    return _met(spark, sf_dir).select("move_type", _C("def_type1").alias("def_type"), effectiveness(_C("move_type"), F.array("def_type1")).alias("effectiveness"), "n")


@query(f"WITH {CHART}, {B} SELECT event_id, coalesce(c1.mult, 1) * coalesce(c2.mult, 1) AS effectiveness FROM b LEFT JOIN chart c1 ON c1.atk = move_type AND c1.def = def_type1 LEFT JOIN chart c2 ON c2.atk = move_type AND c2.def = def_type2")
def type_effectiveness_dual(spark, sf_dir):
    return _battle(spark, sf_dir).select("event_id", effectiveness(_C("move_type"), _C("def_types")).alias("effectiveness"))


@query(ORACLE_SQL["type_effectiveness_dual"])
def type_effectiveness_join(spark, sf_dir):
    return effectiveness_by_join(_battle(spark, sf_dir), "event_id", "move_type", "def_types")


@query(f"SELECT effectiveness, count(*) AS n FROM ({ORACLE_SQL['type_effectiveness_dual']}) GROUP BY 1")
def effectiveness_histogram(spark, sf_dir):
    return type_effectiveness_dual(spark, sf_dir).groupBy("effectiveness").agg(F.count("*").alias("n"))


# ---- damage, stage by stage and whole

@query(f"WITH {STAGES} SELECT event_id, d0 AS base_damage FROM p0")
def base_damage(spark, sf_dir):
    return _stage(spark, sf_dir, base_damage="d0")


@query(f"WITH {B} SELECT event_id, CASE category WHEN 'Physical' THEN attack ELSE sp_attack END AS attack, CASE category WHEN 'Physical' THEN defense ELSE sp_defense END AS defense FROM b")
def stat_selection(spark, sf_dir):
    physical = _C("category") == "Physical"
    return _battle(spark, sf_dir).select("event_id", F.when(physical, _C("attack")).otherwise(_C("sp_attack")).alias("attack"), F.when(physical, _C("defense")).otherwise(_C("sp_defense")).alias("defense"))


@query(f"WITH {STAGES} SELECT event_id, d1 AS damage FROM p1")
def weather_damage(spark, sf_dir):
    return _stage(spark, sf_dir, damage="d1")


@query(f"WITH {STAGES} SELECT event_id, crit AS is_critical, d2 AS damage FROM p2")
def critical_hit(spark, sf_dir):
    return _stage(spark, sf_dir, is_critical="crit", damage="d2")


@query(f"WITH {STAGES} SELECT event_id, d3 AS damage FROM p3")
def damage_roll(spark, sf_dir):
    return _stage(spark, sf_dir, damage="d3")


@query(f"WITH {STAGES} SELECT event_id, d4 AS damage FROM p4")
def same_type_bonus(spark, sf_dir):
    return _stage(spark, sf_dir, damage="d4")


@query(f"WITH {STAGES} SELECT event_id, d5 AS before, d6 AS damage FROM p6")
def burn_penalty(spark, sf_dir):
    return _stage(spark, sf_dir, before="d5", damage="d6")


@query(f"WITH {STAGES} SELECT event_id, d7 AS damage, greatest(1e0, d7) AS at_least_one FROM p7")
def defender_ability(spark, sf_dir):
    return _stage(spark, sf_dir, damage="d7").withColumn("at_least_one", F.greatest(F.lit(1.0), "damage"))


_DAMAGES = """SELECT event_id, CASE category WHEN 'Status' THEN 0e0 ELSE greatest(1e0, d7) END AS damage,
    category <> 'Status' AND crit AS is_critical, CASE category WHEN 'Status' THEN 1e0 ELSE eff END AS effectiveness FROM p7"""


@query(f"WITH {STAGES} {_DAMAGES}")
def calculate_damage(spark, sf_dir):
    return _damages(_battle(spark, sf_dir))


_FROM_STREAM = f"""base AS ({sql(BATTLE)}),
  stream AS (SELECT row_number() OVER (ORDER BY event_id, nth) - 1 AS place, u FROM (SELECT event_id, 0 AS nth, u_crit AS u FROM base UNION ALL SELECT event_id, 1, u_roll FROM base)),
  placed AS (SELECT *, coalesce(sum(CASE category WHEN 'Status' THEN 0 ELSE 2 END) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM base),
  b AS (SELECT placed.* REPLACE (one.u AS u_crit, two.u AS u_roll) FROM placed LEFT JOIN stream one ON one.place = placed.place LEFT JOIN stream two ON two.place = placed.place + 1)"""


@query(f"WITH {STAGES.replace(B, _FROM_STREAM)} {_DAMAGES}")
def calculate_damage_stream(spark, sf_dir):
    """All moves in a row draw from one generator: two draws each, none for Status."""
    battles = _battle(spark, sf_dir)
    stream = draws.stream_of(battles, ["event_id"], ["u_crit", "u_roll"])
    return _damages(draws.with_draws(battles.drop("u_crit", "u_roll"), ["event_id"], draws.damage_draws(_C("category")), stream, ["u_crit", "u_roll"]))


@query(f"WITH {STAGES} SELECT event_id, CAST(0 AS DOUBLE) AS damage, false AS is_critical, CAST(1 AS DOUBLE) AS effectiveness FROM e WHERE category = 'Status'")
def status_moves(spark, sf_dir):
    return _damages(_battle(spark, sf_dir).where("category = 'Status'"))


@query(f"WITH {B} SELECT event_id, {SIMPLE.format(power='40e0', atk='attack', df='defense', u='u_roll')} AS damage FROM b")
def simple_damage(spark, sf_dir):
    return derived(spark, sf_dir, BATTLE).select("event_id", damage.simple_damage(_C("attack"), _C("defense"), _C("u_roll")).alias("damage"))


@query(f"WITH {B} SELECT event_id, CAST(floor(u_roll * 16) AS BIGINT) + 85 AS roll FROM b")
def uniform_integer(spark, sf_dir):
    return derived(spark, sf_dir, BATTLE).select("event_id", damage.uniform_int(_C("u_roll"), 85, 100).alias("roll"))


# ---- encounters

@query(f"WITH {WILD} SELECT event_id, species FROM w")
def encounter_pick(spark, sf_dir):
    return derived(spark, sf_dir, SESSION).select("event_id", encounters.picked(_C("u_pick"))["species"].alias("species"))


@query(ORACLE_SQL["encounter_pick"])
def encounter_pick_join(spark, sf_dir):
    return encounters.pick_by_table(derived(spark, sf_dir, SESSION), dims.encounters(spark), "u_pick").select("event_id", "species")


@query(f"WITH {WILD} SELECT event_id, species, level, hp + level AS max_hp, hp + level AS hp, atk + level // 2 AS atk, def + level // 2 AS def, kind AS type FROM w")
def encounter_stats(spark, sf_dir):
    return derived(spark, sf_dir, SESSION).select("event_id", encounters.picked(_C("u_pick")).alias("row"), "u_level").select("event_id", encounters.wild(_C("row"), _C("u_level")).alias("w")).select("event_id", "w.*")


@query(f"WITH m AS (SELECT event_id, {PLACE[0]} AS x, {PLACE[1]} AS y, {draw(7919, 13)} AS u FROM events) SELECT event_id, {TILE.format(x='x', y='y')} AS tile, {TILE.format(x='x', y='y')} = 'GRASS' AND u < 0.12e0 AS begins FROM m")
def encounter_trigger(spark, sf_dir):
    at = derived(spark, sf_dir, {"event_id": "event_id", "x": PLACE[0], "y": PLACE[1], "u": draw(7919, 13)}).withColumn("tile", dims.tile(_C("x"), _C("y")))
    return at.select("event_id", "tile", encounters.begins(_C("tile"), _C("u")).alias("begins"))


# ---- experience

_GAINS = {"event_id": "event_id", "user_id": "user_id", "ts": "ts", "amount": AMOUNT}


@query(f"""WITH {THRESHOLDS}, g AS (SELECT user_id, CAST(sum({AMOUNT}) AS BIGINT) AS total_exp FROM events GROUP BY user_id)
   SELECT user_id, total_exp, CAST(5 + k AS BIGINT) AS level, CAST(20 + 3 * k AS BIGINT) AS max_hp, CAST(11 + k AS BIGINT) AS atk, CAST(10 + k AS BIGINT) AS def,
          total_exp - total AS exp, next AS to_next FROM g JOIN need ON total <= total_exp AND total_exp < total + next""")
def exp_final_level(spark, sf_dir):
    return progression.final(derived(spark, sf_dir, _GAINS), "user_id", "amount")


@query(f"""WITH {THRESHOLDS}, g AS (SELECT event_id, user_id, {AMOUNT} AS amount, CAST(sum({AMOUNT}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS total_exp FROM events)
   SELECT event_id, user_id, amount, total_exp, CAST(5 + k AS BIGINT) AS level, total_exp - total AS exp, next AS to_next
   FROM g JOIN need ON total <= total_exp AND total_exp < total + next""")
def exp_running_level(spark, sf_dir):
    out = progression.running(derived(spark, sf_dir, _GAINS), "user_id", ["ts", "event_id"], "amount")
    return out.select("event_id", "user_id", "amount", "total_exp", "level", "exp", "to_next")


@query(f"WITH {WILD} SELECT event_id, level * 7 AS award FROM w")
def exp_award(spark, sf_dir):
    return encounter_stats(spark, sf_dir).select("event_id", progression.award(_C("level")).alias("award"))


# ---- the map

def _path(spark: SparkSession, sf_dir: str):
    moves = derived(spark, sf_dir, {"user_id": "user_id", "ts": "ts", "event_id": "event_id", "dx": DX, "dy": DY, "u": draw(7919, 13)})
    return movement.walk_path(moves, "user_id", ["ts", "event_id"])


@query(f"""WITH RECURSIVE {WALK_STEPS}, seen AS (SELECT y, x, count(*) AS n FROM path WHERE moved GROUP BY ALL)
   SELECT CAST(a.y AS INT) AS y, CAST(b.x AS INT) AS x, {TILE.format(x='b.x', y='a.y')} AS tile, coalesce(n, 0) AS n
   FROM range(20) a(y) CROSS JOIN range(30) b(x) LEFT JOIN seen ON seen.x = b.x AND seen.y = a.y""")
def tile_map(spark, sf_dir):
    """The map, and how many steps of all walks led to each place."""
    seen = _path(spark, sf_dir).result().where("moved").groupBy("y", "x").agg(F.count("*").alias("n"))
    return dims.tile_map(spark).join(seen, ["y", "x"], "left").select("y", "x", "tile", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"WITH RECURSIVE {WALK_STEPS} SELECT tile, count(*) AS n FROM path WHERE moved GROUP BY 1")
def tile_histogram(spark, sf_dir):
    """Steps of all walks by what they led to."""
    return _path(spark, sf_dir).result().where("moved").groupBy("tile").agg(F.count("*").alias("n"))


@query(f"""WITH {S}, m AS (SELECT event_id, {PLACE[0]} AS x, {PLACE[1]} AS y, code,
      CASE WHEN code IN ('ArrowLeft', 'KeyA') THEN -1 WHEN code IN ('ArrowRight', 'KeyD') THEN 1 ELSE 0 END AS dx,
      CASE WHEN code IN ('ArrowUp', 'KeyW') THEN -1 WHEN code IN ('ArrowDown', 'KeyS') THEN 1 ELSE 0 END AS dy FROM s)
   SELECT event_id, CASE WHEN x + dx BETWEEN 1 AND 28 THEN x + dx ELSE x END AS x, CASE WHEN y + dy BETWEEN 1 AND 18 THEN y + dy ELSE y END AS y,
      CASE dx WHEN -1 THEN 'LEFT' WHEN 1 THEN 'RIGHT' ELSE CASE dy WHEN -1 THEN 'UP' WHEN 1 THEN 'DOWN' END END AS facing,
      x + dx BETWEEN 1 AND 28 AND y + dy BETWEEN 1 AND 18 AS moved FROM m WHERE dx <> 0 OR dy <> 0""")
def move_step(spark, sf_dir):
    dx, dy, facing = movement.direction(_C("code"))
    at = derived(spark, sf_dir, SESSION).selectExpr("event_id", f"{PLACE[0]} AS x", f"{PLACE[1]} AS y", "code").withColumns({"dx": dx, "dy": dy, "facing": facing})
    went = at.where("dx <> 0 OR dy <> 0").withColumn("to", movement.step(_C("x"), _C("y"), _C("dx"), _C("dy")))
    return went.select("event_id", _C("to.x").alias("x"), _C("to.y").alias("y"), "facing", _C("to.moved").alias("moved"))


@query(f"WITH RECURSIVE {WALK_STEPS} SELECT user_id, x, y, steps, tile FROM path p WHERE i = (SELECT max(i) FROM m WHERE m.user_id = p.user_id)")
def walk_fold(spark, sf_dir):
    moves = derived(spark, sf_dir, {"user_id": "user_id", "ts": "ts", "event_id": "event_id", "dx": DX, "dy": DY})
    return movement.walked(moves, "user_id", ["ts", "event_id"])


@query(f"WITH RECURSIVE {WALK_STEPS} SELECT user_id, event_id, x, y, steps, moved, tile FROM path")
def walk_path(spark, sf_dir):
    """Every move of every walk."""
    return _path(spark, sf_dir).result().select("user_id", "event_id", "x", "y", "steps", "moved", "tile")


@query(f"""WITH RECURSIVE {WALK_STEPS}, h AS (SELECT user_id, event_id, i, steps, moved AND tile = 'GRASS' AND {draw(7919, 13)} < 0.12e0 AS meets FROM path)
   SELECT user_id, event_id, steps, meets, CAST(count(*) FILTER (meets) OVER past AS BIGINT) AS encounters, steps - coalesce(max(CASE WHEN meets THEN steps END) OVER past, 0) AS since
   FROM h WINDOW past AS (PARTITION BY user_id ORDER BY i)""")
def walk_encounters(spark, sf_dir):
    """The walks cut at their encounters."""
    return movement.encounters_along(_path(spark, sf_dir), "u").result().select("user_id", "event_id", "steps", "meets", "encounters", "since")


# ---- capture, turns, display

@query(f"SELECT event_id, CAST(0.25 AS DOUBLE) + (21e0 - {HP}) / 21e0 * CAST(0.55 AS DOUBLE) AS chance FROM events")
def capture_chance(spark, sf_dir):
    hp = derived(spark, sf_dir, {"event_id": "event_id", "hp": HP})
    return hp.select("event_id", battle.capture_chance(_C("hp"), F.lit(21.0)).alias("chance"))


@query(f"""WITH t AS (SELECT event_id, CAST(event_id % 6 AS INT) AS had, {HP} AS hp, {draw(4447, 53)} AS u FROM events)
   SELECT event_id, CASE WHEN had = 0 THEN 0 ELSE had - 1 END AS balls,
          CASE WHEN had = 0 THEN 'REFUSED' WHEN u < CAST(0.25 AS DOUBLE) + (21e0 - hp) / 21e0 * CAST(0.55 AS DOUBLE) THEN 'CAUGHT' ELSE 'BROKE_FREE' END AS result FROM t""")
def capture_outcome(spark, sf_dir):
    t = derived(spark, sf_dir, {"event_id": "event_id", "had": "CAST(event_id % 6 AS INT)", "hp": HP, "u": draw(4447, 53)})
    return t.select("event_id", battle.captured(_C("had"), _C("hp"), F.lit(21.0), _C("u")).alias("r")).select("event_id", "r.*")


@query(f"""WITH t AS (SELECT event_id, user_id, {HP} AS hp, {draw(4447, 53)} AS u, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS thrown FROM events)
   SELECT user_id, event_id, greatest(5 - thrown, 0) AS balls_before, greatest(4 - thrown, 0) AS balls,
     CASE WHEN thrown >= 5 THEN 'REFUSED' WHEN u < CAST(0.25 AS DOUBLE) + (21e0 - hp) / 21e0 * CAST(0.55 AS DOUBLE) THEN 'CAUGHT' ELSE 'BROKE_FREE' END AS result FROM t""")
def throws_in_a_row(spark, sf_dir):
    """Each user's throws one after another, from one stock of five balls."""
    t = derived(spark, sf_dir, {"event_id": "event_id", "user_id": "user_id", "ts": "ts", "hp": HP, "max_hp": "CAST(21 AS DOUBLE)", "u": draw(4447, 53)})
    return battle.throws(t, "user_id", ["ts", "event_id"], "hp", "max_hp", "u").select("user_id", "event_id", "balls_before", "balls", "result")


@query(f"""WITH {THRESHOLDS}, e AS (SELECT user_id, event_id, {HIT} AS hit, row_number() OVER past AS i, CAST(sum({GAIN}) OVER past AS BIGINT) AS total
      FROM events WINDOW past AS (PARTITION BY user_id ORDER BY ts, event_id)),
   l AS (SELECT e.*, k, coalesce(lag(k) OVER (PARTITION BY user_id ORDER BY i), 0) AS had FROM e JOIN need ON need.total <= e.total AND e.total < need.total + next),
   w(user_id, event_id, i, level, max_hp, hp, fainted) AS (
     SELECT DISTINCT user_id, CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(5 AS BIGINT), CAST(20 AS BIGINT), CAST(20 AS BIGINT), false FROM e UNION ALL
     SELECT w.user_id, l.event_id, l.i, CAST(5 + k AS BIGINT), CAST(20 + 3 * k AS BIGINT),
        CAST(CASE WHEN k > had THEN 20 + 3 * k WHEN w.hp > hit THEN w.hp - hit ELSE 20 + 3 * k END AS BIGINT), k = had AND w.hp <= hit
     FROM w JOIN l ON l.user_id = w.user_id AND l.i = w.i + 1)
   SELECT user_id, event_id, level, max_hp, hp, fainted FROM w WHERE i > 0""")
def health_over_time(spark, sf_dir):
    """Level and health after every gain of experience and every hit."""
    events = derived(spark, sf_dir, {"event_id": "event_id", "user_id": "user_id", "ts": "ts", "gain": GAIN, "taken": HIT})
    return progression.health(events, "user_id", ["ts", "event_id"], "gain", "taken").result().select("user_id", "event_id", "level", "max_hp", "hp", "fainted")


@query(f"WITH h AS (SELECT event_id, {HP} / 20e0 AS ratio FROM events) SELECT event_id, CASE WHEN ratio > 0.5e0 THEN '#3f3' WHEN ratio > 0.2e0 THEN '#fc3' ELSE '#f44' END AS colour, greatest(1e0, 148e0 * ratio) AS width FROM h")
def health_band(spark, sf_dir):
    h = derived(spark, sf_dir, {"event_id": "event_id", "ratio": f"{HP} / CAST(20 AS DOUBLE)"})
    return h.select("event_id", display.health_colour(_C("ratio")).alias("colour"), display.health_width(_C("ratio"), F.lit(150.0)).alias("width"))


_TURN_KEYS = pick("(event_id * 5) % 6", ["Digit1", "Digit2", "Digit3", "Digit1", "KeyX", "KeyQ"])
_TURN = f"""{WILD}, q AS (SELECT event_id, {_TURN_KEYS} AS code, species, level, CAST(hp + level AS DOUBLE) AS max_hp,
     least(CAST(hp + level AS DOUBLE), CAST(1 + event_id % 9 AS DOUBLE)) AS wild_hp, atk + level // 2 AS wild_atk, def + level // 2 AS wild_def,
     CAST(1 + event_id % 20 AS DOUBLE) AS hero_hp, CAST(event_id % 6 AS INT) AS balls, u_hit, u_back, u_catch FROM w),
  r AS (SELECT *, {SIMPLE.format(power='40e0', atk='11', df='wild_def', u='u_hit')} AS dealt, {SIMPLE.format(power='35e0', atk='wild_atk', df='10', u='u_back')} AS back,
     CAST(0.25 AS DOUBLE) + (max_hp - wild_hp) / max_hp * CAST(0.55 AS DOUBLE) AS chance FROM q),
  t AS (SELECT *, CASE WHEN code = 'Digit1' THEN CASE WHEN wild_hp - dealt <= 0 THEN 'DEFEATED' WHEN hero_hp - back <= 0 THEN 'FAINTED' ELSE 'GOES_ON' END
     WHEN code = 'Digit2' THEN CASE WHEN balls > 0 AND u_catch < chance THEN 'CAUGHT' ELSE 'GOES_ON' END
     WHEN code IN ('Digit3', 'Escape', 'KeyX') THEN 'ESCAPED' ELSE 'GOES_ON' END AS outcome FROM r)"""


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = derived(spark, sf_dir, SESSION | {"code": _TURN_KEYS, "wild_now": "CAST(1 + event_id % 9 AS DOUBLE)", "hero_hp": "CAST(1 + event_id % 20 AS DOUBLE)", "balls": "CAST(event_id % 6 AS INT)"})
    q = q.withColumn("w", encounters.wild(encounters.picked(_C("u_pick")), _C("u_level")))
    wild = {"species": _C("w.species"), "level": _C("w.level"), "hp": F.least(_C("w.hp").cast("double"), "wild_now"), "max_hp": _C("w.max_hp").cast("double"), "atk": _C("w.atk"), "def": _C("w.def")}
    hero = {"species": F.lit("Charmander"), "hp": _C("hero_hp"), "max_hp": F.lit(20.0), "atk": F.lit(11.0), "def": F.lit(10.0), "balls": _C("balls")}
    return q.select("event_id", battle.turn(_C("code"), hero, wild, _C("u_hit"), _C("u_back"), _C("u_catch")).alias("t")).select("event_id", "t.*")


@query(f"""WITH {_TURN} SELECT event_id,
     CASE WHEN code <> 'Digit1' OR outcome = 'DEFEATED' THEN hero_hp WHEN outcome = 'FAINTED' THEN 20e0 ELSE hero_hp - back END AS hero_hp,
     CASE WHEN code = 'Digit1' THEN greatest(0e0, wild_hp - dealt) ELSE wild_hp END AS wild_hp,
     CASE WHEN code = 'Digit2' AND balls > 0 THEN balls - 1 ELSE balls END AS balls, outcome,
     CASE outcome WHEN 'DEFEATED' THEN level * 7 ELSE 0 END AS exp FROM t""")
def battle_turn(spark, sf_dir):
    return _turns(spark, sf_dir).drop("message")


@query(f"""WITH {_TURN} SELECT event_id, CASE
     WHEN outcome = 'DEFEATED' THEN 'You defeated ' || species || '! +' || level * 7 || ' EXP'
     WHEN outcome = 'FAINTED' THEN 'You blacked out! Auto-healed for demo.'
     WHEN code = 'Digit1' THEN 'Charmander used Ember! ' || CAST(dealt AS BIGINT) || ' dmg. ' || species || ' hit back for ' || CAST(back AS BIGINT) || '.'
     WHEN outcome = 'CAUGHT' THEN 'Gotcha! ' || species || ' was caught!' WHEN code = 'Digit2' AND balls = 0 THEN 'No Poké Balls left!'
     WHEN code = 'Digit2' THEN species || ' broke free!' WHEN outcome = 'ESCAPED' THEN 'Got away safely!' END AS message FROM t""")
def battle_log_text(spark, sf_dir):
    return _turns(spark, sf_dir).select("event_id", "message")


@query(f"""WITH {THRESHOLDS}, g AS (SELECT user_id, CAST(sum({AMOUNT}) AS BIGINT) AS total_exp FROM events GROUP BY user_id)
   SELECT user_id, 'Charmander Lv' || (5 + k) || ' HP ' || (20 + 3 * k) || '/' || (20 + 3 * k) || ' Balls:5' AS hud, 'Charmander grew to Lv.' || (5 + k) || '!' AS grew
   FROM g JOIN need ON total <= total_exp AND total_exp < total + next""")
def hud_text(spark, sf_dir):
    level, hp = display.shown(_C("level")), display.shown(_C("max_hp"))
    return exp_final_level(spark, sf_dir).select("user_id", display.said(display.HUD, level=level, hp=hp, max_hp=hp, balls=F.lit("5")).alias("hud"), display.said(display.GREW, species=F.lit("Charmander"), level=level).alias("grew"))


# Every session frame by frame: one step of the recursion is one frame of every session.
def _states(source: str, scene: str = "TITLE", message: str = "", timer: float = 0.0) -> str:
    """Sessions that begin in a scene, over frames s; of several keys in a frame the first in rank counts."""
    return f"""{THRESHOLDS}, {WILD.replace(S, source)},
  levels AS (SELECT list(total ORDER BY k) AS sums, list(next ORDER BY k) AS nexts FROM need),
  f AS (SELECT * REPLACE (CASE WHEN list_contains(keys, 'Digit1') THEN 'Digit1' WHEN list_contains(keys, 'Digit2') THEN 'Digit2'
        WHEN list_has_any(keys, ['Digit3', 'Escape', 'KeyX']) THEN 'Escape' END AS code), list_has_any(keys, ['Enter', 'KeyZ']) AS starts,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i,
      CASE WHEN list_has_any(keys, ['ArrowUp', 'KeyW', 'ArrowDown', 'KeyS']) THEN 0 WHEN list_has_any(keys, ['ArrowLeft', 'KeyA']) THEN -1 WHEN list_has_any(keys, ['ArrowRight', 'KeyD']) THEN 1 ELSE 0 END AS dx,
      CASE WHEN list_has_any(keys, ['ArrowUp', 'KeyW']) THEN -1 WHEN list_has_any(keys, ['ArrowDown', 'KeyS']) THEN 1 ELSE 0 END AS dy
      FROM (SELECT *, string_split(code, ' ') AS keys FROM w)),
  g(user_id, event_id, i, scene, x, y, facing, steps, total, hp, balls, wild, wild_level, wild_max_hp, wild_hp, wild_atk, wild_def, log, message, timer) AS (
    SELECT DISTINCT user_id, CAST(NULL AS BIGINT), CAST(0 AS BIGINT), '{scene}', 3, 3, 'DOWN', 0, CAST(0 AS BIGINT), 20, 5, CAST(NULL AS VARCHAR), CAST(NULL AS INT), CAST(NULL AS INT),
           CAST(NULL AS INT), CAST(NULL AS INT), CAST(NULL AS INT), CAST(NULL AS VARCHAR), '{message}', CAST({timer} AS DOUBLE) FROM f
    UNION ALL
    SELECT user_id, event_id, i,
      CASE what WHEN 'START' THEN 'OVERWORLD' WHEN 'MEET' THEN 'BATTLE' WHEN 'WAIT' THEN CASE WHEN timer - dt <= 0 THEN 'OVERWORLD' ELSE scene END ELSE CASE WHEN ends THEN 'OVERWORLD' ELSE scene END END,
      CASE WHEN what IN ('STEP', 'MEET') THEN x + dx ELSE x END, CASE WHEN what IN ('STEP', 'MEET') THEN y + dy ELSE y END,
      CASE WHEN what IN ('STEP', 'MEET', 'WALL') THEN CASE WHEN dx = -1 THEN 'LEFT' WHEN dx = 1 THEN 'RIGHT' WHEN dy = -1 THEN 'UP' ELSE 'DOWN' END ELSE facing END,
      CASE WHEN what IN ('STEP', 'MEET') THEN steps + 1 ELSE steps END, total2,
      CAST(CASE what WHEN 'WON' THEN CASE WHEN k2 > k THEN 20 + 3 * k2 ELSE hp END WHEN 'FAINTED' THEN 20 + 3 * k WHEN 'HIT' THEN hp - back ELSE hp END AS INT),
      CASE WHEN what IN ('CAUGHT', 'BROKE') THEN balls - 1 ELSE balls END,
      CASE WHEN ends THEN NULL WHEN what = 'MEET' THEN species ELSE wild END, CAST(CASE WHEN ends THEN NULL WHEN what = 'MEET' THEN level ELSE wild_level END AS INT),
      CAST(CASE WHEN ends THEN NULL WHEN what = 'MEET' THEN new_hp + level ELSE wild_max_hp END AS INT),
      CAST(CASE WHEN ends THEN NULL WHEN what = 'MEET' THEN new_hp + level WHEN what = 'HIT' THEN wild_hp - dealt ELSE wild_hp END AS INT),
      CAST(CASE WHEN what = 'MEET' THEN atk + level // 2 ELSE wild_atk END AS INT), CAST(CASE WHEN what = 'MEET' THEN def + level // 2 ELSE wild_def END AS INT),
      CASE what WHEN 'MEET' THEN 'A wild Pokémon appeared!' WHEN 'HIT' THEN 'Charmander used Ember! ' || CAST(dealt AS BIGINT) || ' dmg. ' || wild || ' hit back for ' || CAST(back AS BIGINT) || '.'
        WHEN 'EMPTY' THEN 'No Poké Balls left!' WHEN 'BROKE' THEN wild || ' broke free!' ELSE CASE WHEN ends THEN NULL ELSE log END END,
      CASE what WHEN 'WON' THEN 'You defeated ' || wild || '! +' || wild_level * 7 || ' EXP' WHEN 'FAINTED' THEN 'You blacked out! Auto-healed for demo.'
        WHEN 'CAUGHT' THEN 'Gotcha! ' || wild || ' was caught!' WHEN 'ESCAPED' THEN 'Got away safely!' ELSE message END,
      CASE WHEN ends THEN CAST(1300 AS DOUBLE) WHEN what = 'WAIT' THEN timer - dt ELSE timer END
    FROM (SELECT *, what IN ('WON', 'FAINTED', 'CAUGHT', 'ESCAPED') AS ends, len(list_filter(sums, lambda z: z <= total2)) - 1 AS k2
      FROM (SELECT *, total + CASE what WHEN 'WON' THEN wild_level * 7 ELSE 0 END AS total2
        FROM (SELECT *, CASE scene WHEN 'TITLE' THEN CASE WHEN starts THEN 'START' ELSE 'NONE' END WHEN 'MESSAGE' THEN 'WAIT'
            WHEN 'OVERWORLD' THEN CASE WHEN dx = 0 AND dy = 0 THEN 'NONE' WHEN x + dx NOT BETWEEN 1 AND 28 OR y + dy NOT BETWEEN 1 AND 18 THEN 'WALL'
              WHEN {TILE.format(x="(x + dx)", y="(y + dy)")} = 'GRASS' AND u_enc < 0.12e0 THEN 'MEET' ELSE 'STEP' END
            ELSE CASE code WHEN 'Digit1' THEN CASE WHEN wild_hp - dealt <= 0 THEN 'WON' WHEN hp - back <= 0 THEN 'FAINTED' ELSE 'HIT' END
              WHEN 'Digit2' THEN CASE WHEN balls <= 0 THEN 'EMPTY' WHEN u_catch < CAST(0.25 AS DOUBLE) + (wild_max_hp - wild_hp) / CAST(wild_max_hp AS DOUBLE) * CAST(0.55 AS DOUBLE) THEN 'CAUGHT' ELSE 'BROKE' END
              ELSE CASE WHEN code = 'Escape' THEN 'ESCAPED' ELSE 'NONE' END END END AS what
          FROM (SELECT *, {SIMPLE.format(power="40e0", atk="(11 + k)", df="wild_def", u="u_hit")} AS dealt, {SIMPLE.format(power="35e0", atk="wild_atk", df="(10 + k)", u="u_back")} AS back
            FROM (SELECT f.event_id, f.code, f.starts, f.dt, f.dx, f.dy, f.u_enc, f.u_hit, f.u_back, f.u_catch, f.species, f.level, f.hp AS new_hp, f.atk, f.def, g.* EXCLUDE (event_id, i), f.i, sums,
                    len(list_filter(sums, lambda z: z <= total)) - 1 AS k
                  FROM g JOIN f ON f.user_id = g.user_id AND f.i = g.i + 1 CROSS JOIN levels))))))"""


SESSION_STATES = _states(S)
_RUN = """h AS (SELECT g.*, len(list_filter(sums, lambda z: z <= total)) - 1 AS k, sums, nexts FROM g CROSS JOIN levels WHERE i > 0)
   SELECT user_id, event_id, scene, x, y, facing, steps, CAST(5 + k AS INT) AS level, CAST(20 + 3 * k AS INT) AS max_hp, hp, total - sums[k + 1] AS exp, nexts[k + 1] AS to_next,
          balls, wild, wild_level, wild_max_hp, wild_hp, log, message, timer FROM h"""


@query(f"WITH {SESSION_STATES}, {_RUN}")
def session_run(spark, sf_dir):
    """Every frame of every session."""
    return run_batch(derived(spark, sf_dir, SESSION))


_COLOUR = "CASE WHEN {r} > 0.5e0 THEN '#3f3' WHEN {r} > 0.2e0 THEN '#fc3' ELSE '#f44' END"


@query(f"""WITH {SESSION_STATES}, h AS (SELECT g.*, len(list_filter(sums, lambda z: z <= total)) - 1 AS k FROM g CROSS JOIN levels WHERE i > 0),
   r AS (SELECT *, scene = 'BATTLE' AS b, 20 + 3 * k AS max_hp, hp / CAST(20 + 3 * k AS DOUBLE) AS own, wild_hp / CAST(wild_max_hp AS DOUBLE) AS other FROM h)
   SELECT event_id, CASE WHEN scene = 'OVERWORLD' THEN 'Charmander Lv' || (5 + k) || ' HP ' || hp || '/' || max_hp || ' Balls:' || balls END AS hud,
      CASE WHEN b THEN wild || ' Lv' || wild_level END AS wild_tag, CASE WHEN b THEN {_COLOUR.format(r="other")} END AS wild_colour, CASE WHEN b THEN greatest(1e0, 148e0 * other) END AS wild_width,
      CASE WHEN b THEN 'Charmander Lv' || (5 + k) END AS hero_tag, CASE WHEN b THEN {_COLOUR.format(r="own")} END AS hero_colour, CASE WHEN b THEN greatest(1e0, 148e0 * own) END AS hero_width,
      CASE WHEN b THEN hp || '/' || max_hp END AS hero_hp, CASE WHEN b THEN log END AS log FROM r""")
def session_display(spark, sf_dir):
    """What each frame shows: the head line on the map; in a battle name tags, health bars and the log."""
    return display.shown_frame(session_run(spark, sf_dir))


@query(f"WITH {_states(S, 'MESSAGE', 'Welcome back!', 1300.0)}, {_RUN}")
def session_after_message(spark, sf_dir):
    """Sessions that begin under a message: the map comes back when its time has run out."""
    return run_batch(derived(spark, sf_dir, SESSION), fresh() | {"scene": "MESSAGE", "message": "Welcome back!", "timer": 1300.0})


# Frames from key events: within a frame the last event of a key says whether it is held.
_FRAMES = f"""(SELECT user_id, frame, max(ts) AS ts, max_by(event_id, (ts, event_id)) AS event_id, coalesce(string_agg(code, ' ' ORDER BY code) FILTER (held AND last), '') AS code
   FROM (SELECT *, kind = 'down' AS held, row_number() OVER (PARTITION BY user_id, frame, code ORDER BY ts DESC, event_id DESC) = 1 AS last FROM ({sql(KEYS)})) GROUP BY user_id, frame)"""


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.pressed(derived(spark, sf_dir, KEYS), "user_id", "frame", ["ts", "event_id"])


@query(f"SELECT user_id, frame, ts, event_id, code FROM {_FRAMES}")
def key_frames(spark, sf_dir):
    """The keys that each frame reads."""
    return _frames(spark, sf_dir).select("user_id", "frame", "ts", "event_id", "code")


@query(f"WITH {_states('s AS (' + sql(SESSION | {'code': 'code'}, _FRAMES) + ')')}, {_RUN}")
def key_session(spark, sf_dir):
    """Sessions from key events, frame by frame."""
    read = _frames(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in (SESSION | {"code": "code"}).items()])
    return run_batch(read)
