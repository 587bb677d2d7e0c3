"""How well a move's type does against a defender's types."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.sources.dims import chart_cells, type_chart


def chart_map() -> Column:
    return F.create_map(*chain.from_iterable((F.lit(f"{a}>{d}"), F.lit(m)) for a, d, m in chart_cells()))


def factor(move_type: Column, defender_type: Column) -> Column:
    """One cell of the chart; 1 where the chart has none."""
    return F.coalesce(F.element_at(chart_map(), F.concat(move_type, F.lit(">"), defender_type)), F.lit(1.0))


def effectiveness(move_type: Column, defender_types: Column) -> Column:
    """Product over the defender's types: 1 for none, and a type given twice counts twice. Null types count as none."""
    return F.aggregate(F.coalesce(defender_types, F.array().cast("array<string>")), F.lit(1.0), lambda product, t: product * factor(move_type, t))


def effectiveness_by_join(rows: DataFrame, key: str, move_type: str, defender_types: str) -> DataFrame:
    """The same as (key, effectiveness) for each row, by a broadcast join to the 120 cells; keys may repeat. It shuffles,
    which effectiveness() doesn't: a cross-check."""
    numbered = rows.select(F.monotonically_increasing_id().alias("_no"), F.col(key).alias("_key"), F.col(move_type).alias("_move"), F.col(defender_types).alias("_types"))
    numbered = numbered.select("_no", "_key", "_move", F.explode_outer("_types").alias("_def"))
    cells = F.broadcast(type_chart(rows.sparkSession))
    joined = numbered.join(cells, (F.col("_move") == F.col("atk")) & (F.col("_def") == F.col("def")), "left")
    return joined.groupBy("_no").agg(F.first("_key").alias(key), F.product(F.coalesce("mult", F.lit(1.0))).alias("effectiveness")).drop("_no")
