"""The damage rules, stage by stage. Each stage takes the damage so far, a whole number held as a double, and floors.

A factor of 1 leaves a whole number as it is, so every stage is floor(damage * factor) and mentions the damage once;
inlined, the stages stay one expression of linear size. Randomness comes in as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skirmish.functions.effectiveness import effectiveness


def floored(value: Column) -> Column:
    return F.floor(value).cast("double")


def base_damage(level: Column, power: Column, attack: Column, defense: Column) -> Column:
    """The quotient of the stats is formed before it multiplies; another order rounds otherwise. Null for no defense."""
    ratio = attack / F.nullif(defense, F.lit(0.0))
    return floored((F.lit(2.0) * level / F.lit(5.0) + F.lit(2.0)) * power * ratio / F.lit(50.0)) + F.lit(2.0)


def undefended(attack: Column, power: Column, times: Column) -> Column:
    """What floating point makes of a defense of zero, for which base_damage() is null: no bound, or no number."""
    return F.when((attack > 0) & (power > 0) & (times > 0), float("inf")).otherwise(float("nan"))


def stage(damage: Column, times: Column) -> Column:
    return floored(damage * times)


def weather_factor(weather: Column, move_type: Column) -> Column:
    better = ((weather == "SUN") & (move_type == "Fire")) | ((weather == "RAIN") & (move_type == "Water"))
    worse = ((weather == "SUN") & (move_type == "Water")) | ((weather == "RAIN") & (move_type == "Fire"))
    return F.when(better, 1.5).when(worse, 0.5).otherwise(1.0)


def is_critical(bonus: Column, u_crit: Column) -> Column:
    """Stages 0 to 3 have chances 1/24, 1/8, 1/2 and 1; a stage that is none of them, or no number, never hits."""
    level = F.when(~F.isnan(F.coalesce(bonus, F.lit(0.0))), F.least(F.coalesce(bonus, F.lit(0.0)), F.lit(3.0)))
    chance = F.when(level == 0, 1 / 24).when(level == 1, 1 / 8).when(level == 2, 1 / 2).when(level == 3, 1.0)
    return F.coalesce(u_crit < chance, F.lit(False))


def critical_factor(critical: Column) -> Column:
    return F.when(critical, 1.5).otherwise(1.0)


def roll_factor(u_roll: Column) -> Column:
    return floored(u_roll * 16 + 85) / 100


def same_type_factor(types: Column, move_type: Column, ability: Column) -> Column:
    bonus = F.when(ability.eqNullSafe("Adaptability"), 2.0).otherwise(1.5)
    return F.when(F.coalesce(F.array_contains(types, move_type), F.lit(False)), bonus).otherwise(1.0)


def burn_factor(status: Column, category: Column, ability: Column) -> Column:
    return F.when(status.eqNullSafe("BURN") & (category == "Physical") & ~ability.eqNullSafe("Guts"), 0.5).otherwise(1.0)


def defender_factor(ability: Column, move_type: Column) -> Column:
    return F.when(ability.eqNullSafe("Thick Fat") & move_type.isin("Fire", "Ice"), 0.5).otherwise(1.0)


def calculate_damage(attacker: dict[str, Column], defender: dict[str, Column], move: dict[str, Column], weather: Column, u_crit: Column, u_roll: Column) -> Column:
    """struct(damage, is_critical, effectiveness). At least 1 for all but Status moves, even against the immune."""
    physical = move["category"] == "Physical"
    attack = F.when(physical, attacker["attack"]).otherwise(attacker["sp_attack"])
    defense = F.when(physical, defender["defense"]).otherwise(defender["sp_defense"])
    critical, times = is_critical(move["crit_bonus"], u_crit), effectiveness(move["type"], defender["types"])
    damage = base_damage(attacker["level"], move["base_power"], attack, defense)
    for part in (
        weather_factor(weather, move["type"]),
        critical_factor(critical),
        roll_factor(u_roll),
        same_type_factor(attacker["types"], move["type"], attacker["ability"]),
        times,
        burn_factor(attacker["status"], move["category"], attacker["ability"]),
        defender_factor(defender["ability"], move["type"]),
    ):
        damage = stage(damage, part)
    damage = F.when(defense == 0, undefended(attack, move["base_power"], times)).otherwise(F.greatest(F.lit(1.0), damage))
    status = move["category"] == "Status"
    return F.struct(
        F.when(status, 0.0).otherwise(damage).alias("damage"),
        (~status & critical).alias("is_critical"),
        F.when(status, 1.0).otherwise(times).alias("effectiveness"),
    )


def uniform_int(u: Column, low: Column | int, high: Column | int) -> Column:
    """A whole number from low to high, both included."""
    low, high = (F.lit(x) if isinstance(x, int) else x for x in (low, high))
    return (F.floor(u * (high - low + 1)) + low).cast("long")


def simple_damage(atk: Column, defense: Column, u: Column, power: float = 40.0) -> Column:
    """The game's own rule: as if always at level 5, blind to types, weather and luck beyond one roll."""
    base = floored(F.lit(4.0) * F.lit(power) * (atk / F.nullif(defense, F.lit(0.0))) / F.lit(50.0)) + F.lit(2.0)
    damage = F.greatest(F.lit(1.0), floored(base * (uniform_int(u, 85, 100) / 100)))
    return F.when(defense == 0, undefended(atk, F.lit(power), F.lit(1.0))).otherwise(damage)
