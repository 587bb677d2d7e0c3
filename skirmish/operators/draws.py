"""Draws taken one after another from a single stream, as by a generator that all rows share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.operators.scans import numbered


def damage_draws(category: Column) -> Column:
    """How many draws a move consumes: none for Status, else one for the critical hit and one for the roll."""
    return F.when(category == "Status", 0).otherwise(2)


def stream_of(rows: DataFrame, order: list[str], draws: list[str]) -> DataFrame:
    """(place, u): the draws of each row in turn, over rows in one order of the whole table."""
    each = rows.select(*order, F.posexplode(F.array(*draws)).alias("_nth", "u"))
    return numbered(each, [*order, "_nth"]).select("place", "u")


def with_draws(rows: DataFrame, order: list[str], need: Column, stream: DataFrame, names: list[str]) -> DataFrame:
    """The rows with a column a name: in the order of the whole table every row takes its next `need` draws of the stream
    (place, u; places from 0), the first into the first name. What a row doesn't take is null; a stream that is too short is an error.

    Where a row's draws begin is an exclusive prefix sum; rows that take none stay out of the joins, as all of a run of them
    stand at one place."""
    placed = numbered(rows.withColumn("_need", need), order, "_place", "_need").withColumn("_need", need)
    taking, short = placed.where("_need > 0"), F.raise_error(F.lit("the stream has too few draws")).cast("double")
    for i, name in enumerate(names):
        at = stream.select((F.col("place") - i).alias("_place"), F.col("u").alias("_u"), F.lit(True).alias("_there"))
        taking = taking.join(at, "_place", "left")
        taking = taking.withColumn(name, F.when(F.col("_need") <= i, None).when(F.col("_there"), F.col("_u")).otherwise(short)).drop("_u", "_there")
    idle = placed.where("_need <= 0 OR _need IS NULL").withColumns({name: F.lit(None).cast("double") for name in names})
    return taking.unionByName(idle).drop("_need", "_place")
