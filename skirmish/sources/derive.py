"""Battle inputs derived from `events` by arithmetic on event_id, the same text in Spark and in other SQL engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skirmish.sources.dims import TYPES


def pick(expr: str, values: list[str | None]) -> str:
    """SQL for the value whose place is expr."""
    arms = " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def draw(factor: int, shift: int) -> str:
    """SQL for a uniform draw in [0, 1)."""
    return f"(CAST((event_id * {factor} + {shift}) % 10007 AS DOUBLE) / CAST(10007 AS DOUBLE))"


def number(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


BATTLE = {
    "event_id": "event_id",
    "user_id": "user_id",
    "ts": "ts",
    "atk_level": number("1 + event_id % 100"),
    "atk_type1": pick("event_id % 18", TYPES),
    "atk_type2": pick("(event_id * 7 + 5) % 23", TYPES),
    "attack": number("5 + (event_id * 13) % 150"),
    "sp_attack": number("5 + (event_id * 29) % 140"),
    "atk_status": pick("event_id % 7", ["BURN", None, "PARALYSIS", "BURN", "POISON", "SLEEP", "FREEZE"]),
    "atk_ability": pick("(event_id * 3) % 11", ["Adaptability", "Guts", None, "Thick Fat", "Guts"]),
    "def_type1": pick("(event_id * 11 + 2) % 18", TYPES),
    "def_type2": pick("(event_id * 5 + 1) % 29", TYPES),
    "defense": number("1 + (event_id * 17) % 200"),
    "sp_defense": number("1 + (event_id * 19) % 180"),
    "def_ability": pick("event_id % 4", ["Thick Fat", None, "Guts", "Thick Fat"]),
    "move_type": pick("(event_id * 5 + 1) % 18", TYPES),
    "category": pick("(event_id * 7) % 10", ["Status", *["Physical"] * 5, *["Special"] * 4]),
    "base_power": number("10 + (event_id * 7) % 140"),
    "crit_bonus": "CAST(CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 9 WHEN 6 THEN -1 ELSE 0 END AS DOUBLE)",
    "weather": pick("(event_id * 3 + 1) % 5", ["NONE", "RAIN", "SUN", "SANDSTORM", "HAIL"]),
    "u_crit": draw(7919, 13),
    "u_roll": draw(104729, 7),
}
SESSION = {
    "event_id": "event_id",
    "user_id": "user_id",
    "ts": "ts",
    "dt": number("10 + event_id % 50"),
    "code": pick("(event_id * 7) % 12", ["ArrowUp", "KeyS", "ArrowLeft", "KeyD", "Digit1", "Digit2", "Enter", "Digit1", "Escape", "ArrowDown", "ArrowRight", "Digit1"]),
    "u_enc": draw(7919, 13),
    "u_pick": draw(104729, 7),
    "u_level": draw(3571, 101),
    "u_hit": draw(611953, 29),
    "u_back": draw(2741, 17),
    "u_catch": draw(4447, 53),
}
# Key events: a frame is a day, and of the keys some are let go.
KEYS = {
    "event_id": "event_id",
    "user_id": "user_id",
    "ts": "ts",
    "frame": "date_trunc('day', ts)",
    "code": pick("(event_id * 7) % 5", ["ArrowDown", "KeyD", "Digit1", "Enter", "Digit2"]),
    "kind": pick("event_id % 3", ["up", "down", "down"]),
}


def sql(columns: dict[str, str], table: str = "events") -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {table}"


def derived(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])
