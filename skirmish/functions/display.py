"""Health bars and lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def health_colour(ratio: Column) -> Column:
    return F.when(ratio > 0.5, "#3f3").when(ratio > 0.2, "#fc3").otherwise("#f44")


def health_width(ratio: Column, width: Column) -> Column:
    return F.greatest(F.lit(1.0), (width - 2) * ratio)


def shown(value: Column) -> Column:
    """A whole number without its point."""
    return value.cast("long").cast("string")


def said(template: str, **values: Column) -> Column:
    """Text with {name} replaced; numbers must be shown() before."""
    parts, rest = [], template
    for name, value in values.items():
        before, rest = rest.split("{" + name + "}", 1)
        parts += [F.lit(before), value]
    return F.concat(*parts, F.lit(rest))


def shown_frame(states: DataFrame) -> DataFrame:
    """What each session state shows: the head line on the map; in a battle name tags, health bars and the log."""
    c, battle, hero = F.col, F.col("scene") == "BATTLE", F.lit("Charmander")
    own, other = c("hp") / c("max_hp"), c("wild_hp") / c("wild_max_hp")
    shows = {
        "hud": F.when(c("scene") == "OVERWORLD", said(HUD, level=shown(c("level")), hp=shown(c("hp")), max_hp=shown(c("max_hp")), balls=shown(c("balls")))),
        "wild_tag": F.when(battle, said(NAME_TAG, species=c("wild"), level=shown(c("wild_level")))),
        "wild_colour": F.when(battle, health_colour(other)), "wild_width": F.when(battle, health_width(other, F.lit(150.0))),
        "hero_tag": F.when(battle, said(NAME_TAG, species=hero, level=shown(c("level")))),
        "hero_colour": F.when(battle, health_colour(own)), "hero_width": F.when(battle, health_width(own, F.lit(150.0))),
        "hero_hp": F.when(battle, F.concat_ws("/", shown(c("hp")), shown(c("max_hp")))),
        "log": F.when(battle, c("log")),
    }
    return states.select("event_id", *[v.alias(k) for k, v in shows.items()])


# The texts, with the places of their values.
HUD = "Charmander Lv{level} HP {hp}/{max_hp} Balls:{balls}"
NAME_TAG = "{species} Lv{level}"
APPEARED = "A wild Pokémon appeared!"
ATTACKED = "{species} used Ember! {dealt} dmg."
HIT_BACK = " {species} hit back for {back}."
DEFEATED = "You defeated {species}! +{exp} EXP"
GREW = "{species} grew to Lv.{level}!"
CAUGHT = "Gotcha! {species} was caught!"
BROKE_FREE = "{species} broke free!"
NO_BALLS = "No Poké Balls left!"
FAINTED = "You blacked out! Auto-healed for demo."
ESCAPED = "Got away safely!"
