"""Dimension tables: types, the type chart, wild encounters, the tile map, experience thresholds."""

from __future__ import annotations

from functools import cache
from math import floor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The eighteen types, and for each attacking type the defending types on which its factor isn't 1.
TYPES = ["Normal", "Fire", "Water", "Grass", "Electric", "Ice", "Fighting", "Poison", "Ground", "Flying", "Psychic", "Bug", "Rock", "Ghost", "Dragon", "Dark", "Steel", "Fairy"]
CHART = {
    "Normal": {"Rock": 0.5, "Ghost": 0.0, "Steel": 0.5},
    "Fire": {"Fire": 0.5, "Water": 0.5, "Grass": 2.0, "Ice": 2.0, "Bug": 2.0, "Rock": 0.5, "Dragon": 0.5, "Steel": 2.0},
    "Water": {"Fire": 2.0, "Water": 0.5, "Grass": 0.5, "Ground": 2.0, "Rock": 2.0, "Dragon": 0.5},
    "Grass": {"Fire": 0.5, "Water": 2.0, "Grass": 0.5, "Poison": 0.5, "Ground": 2.0, "Flying": 0.5, "Bug": 0.5, "Rock": 2.0, "Dragon": 0.5, "Steel": 0.5},
    "Electric": {"Water": 2.0, "Grass": 0.5, "Electric": 0.5, "Ground": 0.0, "Flying": 2.0, "Dragon": 0.5},
    "Ice": {"Fire": 0.5, "Water": 0.5, "Grass": 2.0, "Ice": 0.5, "Ground": 2.0, "Flying": 2.0, "Dragon": 2.0, "Steel": 0.5},
    "Fighting": {"Normal": 2.0, "Ice": 2.0, "Poison": 0.5, "Flying": 0.5, "Psychic": 0.5, "Bug": 0.5, "Rock": 2.0, "Ghost": 0.0, "Dark": 2.0, "Steel": 2.0, "Fairy": 0.5},
    "Poison": {"Grass": 2.0, "Poison": 0.5, "Ground": 0.5, "Rock": 0.5, "Ghost": 0.5, "Steel": 0.0, "Fairy": 2.0},
    "Ground": {"Fire": 2.0, "Grass": 0.5, "Electric": 2.0, "Poison": 2.0, "Flying": 0.0, "Bug": 0.5, "Rock": 2.0, "Steel": 2.0},
    "Flying": {"Grass": 2.0, "Electric": 0.5, "Fighting": 2.0, "Bug": 2.0, "Rock": 0.5, "Steel": 0.5},
    "Psychic": {"Fighting": 2.0, "Poison": 2.0, "Psychic": 0.5, "Dark": 0.0, "Steel": 0.5},
    "Bug": {"Fire": 0.5, "Grass": 2.0, "Fighting": 0.5, "Poison": 0.5, "Flying": 0.5, "Psychic": 2.0, "Ghost": 0.5, "Dark": 2.0, "Steel": 0.5, "Fairy": 0.5},
    "Rock": {"Fire": 2.0, "Ice": 2.0, "Fighting": 0.5, "Ground": 0.5, "Flying": 2.0, "Bug": 2.0, "Steel": 0.5},
    "Ghost": {"Normal": 0.0, "Psychic": 2.0, "Ghost": 2.0, "Dark": 0.5},
    "Dragon": {"Dragon": 2.0, "Steel": 0.5, "Fairy": 0.0},
    "Dark": {"Fighting": 0.5, "Psychic": 2.0, "Ghost": 2.0, "Dark": 0.5, "Fairy": 0.5},
    "Steel": {"Fire": 0.5, "Water": 0.5, "Electric": 0.5, "Ice": 2.0, "Rock": 2.0, "Steel": 0.5, "Fairy": 2.0},
    "Fairy": {"Fire": 0.5, "Fighting": 2.0, "Poison": 0.5, "Dragon": 2.0, "Dark": 2.0, "Steel": 0.5},
}

# Wild encounters in drawing order, and the starter.
ENCOUNTER_COLUMNS = ["ord", "species", "min", "max", "weight", "hp", "atk", "def", "type"]
ENCOUNTERS = [
    (0, "Pidgey", 2, 4, 55, 18, 10, 10, "Normal"),
    (1, "Rattata", 2, 4, 35, 16, 11, 8, "Normal"),
    (2, "Pikachu", 3, 5, 10, 17, 12, 8, "Electric"),
]
STARTER = {"species": "Charmander", "level": 5, "max_hp": 20, "hp": 20, "atk": 11, "def": 10, "type": "Fire", "exp": 0, "to_next": 20, "balls": 5}
# The size of the map, its two meadows (x from, x to, y from, y to), and where a walk begins.
MAP_W, MAP_H = 30, 20
MEADOWS = [(5, 11, 6, 10), (17, 26, 3, 7)]
START = (3, 3)


def chart_cells() -> list[tuple[str, str, float]]:
    """(attacking, defending, factor) for the cells that aren't 1."""
    return [(attacking, defending, factor) for attacking, row in CHART.items() for defending, factor in row.items()]


def type_chart(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(chart_cells(), "atk string, def string, mult double")


def types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(TYPES)), "ord int, type string")


def encounters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ENCOUNTERS, "ord int, species string, min int, max int, weight int, hp int, atk int, def int, type string")


def tile(x: Column, y: Column) -> Column:
    """What stands at a place of the map."""
    edge = (x == 0) | (y == 0) | (x == MAP_W - 1) | (y == MAP_H - 1)
    grass = F.lit(False)
    for x0, x1, y0, y1 in MEADOWS:
        grass = grass | (x.between(x0, x1) & y.between(y0, y1))
    return F.when(edge, "WALL").when(grass, "GRASS").otherwise("GROUND")


def tile_map(spark: SparkSession) -> DataFrame:
    cells = spark.range(MAP_W * MAP_H).select((F.col("id") % MAP_W).cast("int").alias("x"), F.floor(F.col("id") / MAP_W).cast("int").alias("y"))
    return cells.select("y", "x", tile(F.col("x"), F.col("y")).alias("tile"))


@cache
def thresholds() -> list[tuple[int, int, int]]:
    """(levels gained, experience needed in all, experience to the next level), as far as a long holds the sums."""
    out, total, need = [], 0, STARTER["to_next"]
    while total + need < 1 << 63:
        out.append((len(out), total, need))
        total, need = total + need, floor(need * 1.3)
    return out


def experience_limit() -> int:
    """The first total that the thresholds don't cover."""
    _, total, need = thresholds()[-1]
    return total + need
