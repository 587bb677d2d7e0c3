"""From key events to frames: which keys are held when a frame is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pressed(events: DataFrame, session: str, frame: str, order: list[str], code: str = "code", kind: str = "kind") -> DataFrame:
    """A row for each frame of a session that has key events: session, frame, the order columns of its last event, and
    the codes held, parted by blanks, in order of the alphabet.

    The set of keys begins empty in every frame. A `down` adds its key, an `up` takes it out: a key pressed and let go within
    a frame is lost, and what holds is the last event of each key. Events of other kinds or without a code do nothing."""
    at = F.struct(*order)
    known = F.col(kind).isin("down", "up") & F.col(code).isNotNull()
    keys = events.groupBy(session, frame, code).agg(F.max_by(F.col(kind) == "down", F.when(known, at)).alias("_held"), F.max(at).alias("_at"))
    held = F.array_sort(F.collect_list(F.when(F.col("_held"), F.col(code))))
    frames = keys.groupBy(session, frame).agg(F.concat_ws(" ", held).alias("_codes"), F.max("_at").alias("_at"))
    return frames.select(session, frame, "_at.*", F.col("_codes").alias(code))
