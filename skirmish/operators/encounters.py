"""Wild encounters: whether one begins, which, and with what stats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skirmish.functions.damage import uniform_int
from skirmish.sources.dims import ENCOUNTER_COLUMNS, ENCOUNTERS

ENCOUNTER_CHANCE = 0.12  # fixed value


def begins(tile: Column, u: Column) -> Column:
    """A draw counts on grass only."""
    return (tile == "GRASS") & (u < ENCOUNTER_CHANCE)


def picked(u: Column) -> Column:
    """The encounter's row as a struct: the first whose running weight the roll doesn't exceed."""
    roll, running, out = u * sum(e[4] for e in ENCOUNTERS), 0, None
    for row in ENCOUNTERS:
        running += row[4]
        value = F.struct(*[F.lit(v).alias(c) for c, v in zip(ENCOUNTER_COLUMNS, row, strict=True)])
        out = F.when(roll <= running, value) if out is None else out.when(roll <= running, value)
    return out


def weight_ranges(table: DataFrame, part_rows: int = 100_000) -> DataFrame:
    """The table's rows that can be picked with _low and _high of their running weight, the _total, and whether they
    are the _first. Running sums are taken part by part of the order (a number), so no task sorts the whole table."""
    n = table.count()
    edges = table.approxQuantile("ord", [i * part_rows / n for i in range(1, -(-n // part_rows))], 0.001) if n > part_rows else []
    parted = table.withColumn("_part", F.size(F.filter(F.lit(edges).cast("array<double>"), lambda e: e < F.col("ord"))))
    sums = {r["_part"]: (r["sum"], r["least"]) for r in parted.groupBy("_part").agg(F.sum("weight").alias("sum"), F.min("ord").alias("least")).collect()}
    before, running = F.lit(0), 0
    for part in sorted(sums):
        before = F.when(F.col("_part") == part, running).otherwise(before)
        running += sums[part][0]
    first = min((least for _, least in sums.values()), default=None)
    upto = Window.partitionBy("_part").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    ranges = parted.withColumn("_high", F.sum("weight").over(upto) + before).withColumn("_low", F.col("_high") - F.col("weight"))
    ranges = ranges.withColumn("_first", F.col("ord") == F.lit(first)).withColumn("_total", F.lit(running))
    # Behind the first a weight of zero is never picked.
    return ranges.where("weight > 0 OR _first").drop("_part")


def pick_by_table(rows: DataFrame, table: DataFrame, u: str, broadcast_rows: int = 10_000) -> DataFrame:
    """The same with weights from a table of any size (ord, a number without repeats, and weight): a broadcast range join
    up to broadcast_rows rows; beyond them ranges and rolls are dealt to as many bins as the table has rows, and joined
    within a bin."""
    ranges, n = weight_ranges(table), table.count()
    roll = F.col(u) * F.col("_total")
    # The first range is closed below: a roll of 0 takes the first row, whatever its weight.
    within = (roll <= F.col("_high")) & ((roll > F.col("_low")) | (F.col("_first") & (roll <= 0)))
    if n <= broadcast_rows:
        return rows.join(F.broadcast(ranges), within).drop("_high", "_low", "_total", "_first")
    bin_of = lambda share: F.least(F.floor(share * n), F.lit(n - 1))
    share = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("_total").cast("double")), F.lit(0.0))
    # A bin more on either side, as the shares are rounded.
    dealt = ranges.withColumn("_bin", F.explode(F.sequence(F.greatest(bin_of(share("_low")) - 1, F.lit(0)), F.least(bin_of(share("_high")) + 1, F.lit(n - 1)))))
    return rows.withColumn("_bin", bin_of(F.col(u))).join(dealt, "_bin").where(within).drop("_bin", "_high", "_low", "_total", "_first")


def wild(row: Column, u_level: Column) -> Column:
    """struct(species, level, max_hp, hp, atk, def, type) of an encounter's row."""
    level = uniform_int(u_level, row["min"], row["max"])
    half = F.floor(level / 2)
    hp = row["hp"] + level
    return F.struct(row["species"].alias("species"), level.alias("level"), hp.alias("max_hp"), hp.alias("hp"), (row["atk"] + half).alias("atk"), (row["def"] + half).alias("def"), row["type"].alias("type"))
