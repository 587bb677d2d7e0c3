"""One turn of a battle, and the odds of a capture, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.functions.damage import simple_damage
from skirmish.functions.display import ATTACKED, BROKE_FREE, CAUGHT, DEFEATED, ESCAPED, FAINTED, HIT_BACK, NO_BALLS, said, shown
from skirmish.operators.scans import Counter, ordered, scan
from skirmish.sources.dims import STARTER

# The powers of both sides, and the keys that run away.
ATTACK_POWER, RETALIATION_POWER = 40.0, 35.0
FLEE = ("Digit3", "Escape", "KeyX")


def capture_chance(hp: Column, max_hp: Column) -> Column:
    return F.lit(0.25) + (max_hp - hp) / max_hp * F.lit(0.55)


def captured(balls: Column, hp: Column, max_hp: Column, u: Column) -> Column:
    """struct(balls, result): a throw without balls is refused and changes nothing."""
    none = balls <= 0
    result = F.when(none, "REFUSED").when(u < capture_chance(hp, max_hp), "CAUGHT").otherwise("BROKE_FREE")
    return F.struct(F.when(none, balls).otherwise(balls - 1).alias("balls"), result.alias("result"))


def throws(rows: DataFrame, key: str, order: list[str], hp: str, max_hp: str, u: str, stock: int = STARTER["balls"]) -> DataFrame:
    """Throws in a row from one stock a key: each with the balls before and after it and its result. The stock falls to
    0 and no further; from there on throws are refused, whatever the draw."""
    counted = scan(ordered(rows.withColumn("_throw", F.lit(-1)), [key], order), Counter("balls", "_throw", stock, low=0)).result()
    return counted.withColumn("result", captured(F.col("balls_before"), F.col(hp), F.col(max_hp), F.col(u))["result"]).drop("_throw")


def turn(code: Column, hero: dict[str, Column], wild: dict[str, Column], u_hit: Column, u_back: Column, u_catch: Column) -> Column:
    """struct(hero_hp, wild_hp, balls, outcome, exp, message): one key in a battle.

    Fighting comes before throwing a ball, and that before running. A defeated wild one doesn't hit back; a hero that
    faints is healed and the battle is over; a failed throw isn't punished. Other keys do nothing."""
    fight, throw, flee = code == "Digit1", code == "Digit2", code.isin(*FLEE)
    dealt = simple_damage(hero["atk"], wild["def"], u_hit, ATTACK_POWER)
    back = simple_damage(wild["atk"], hero["def"], u_back, RETALIATION_POWER)
    wild_hp = F.when(fight, F.greatest(F.lit(0.0), wild["hp"] - dealt)).otherwise(wild["hp"])
    won = fight & (wild_hp <= 0)
    hurt = F.greatest(F.lit(0.0), hero["hp"] - back)
    fainted = fight & ~won & (hurt <= 0)
    thrown = captured(hero["balls"], wild["hp"], wild["max_hp"], u_catch)
    caught = throw & (thrown["result"] == "CAUGHT")
    exp = F.when(won, wild["level"] * 7).otherwise(0)
    hits = F.concat(said(ATTACKED, species=hero["species"], dealt=shown(dealt)), said(HIT_BACK, species=wild["species"], back=shown(back)))
    message = (
        F.when(won, said(DEFEATED, species=wild["species"], exp=shown(exp)))
        .when(fainted, FAINTED).when(fight, hits)
        .when(caught, said(CAUGHT, species=wild["species"])).when(throw & (thrown["result"] == "REFUSED"), NO_BALLS)
        .when(throw, said(BROKE_FREE, species=wild["species"])).when(flee, ESCAPED)
    )
    return F.struct(
        F.when(won | ~fight, hero["hp"]).when(fainted, hero["max_hp"]).otherwise(hurt).alias("hero_hp"),
        wild_hp.alias("wild_hp"),
        F.when(throw, thrown["balls"]).otherwise(hero["balls"]).alias("balls"),
        F.when(won, "DEFEATED").when(fainted, "FAINTED").when(caught, "CAUGHT").when(flee, "ESCAPED").otherwise("GOES_ON").alias("outcome"),
        exp.alias("exp"), message.alias("message"),
    )
