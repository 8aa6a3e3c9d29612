"""Cutting vessels into parts of one fixed time step.

Everything that needs a vessel's messages in order works on (mmsi, part): a part is one step of
UTC time, the same for every vessel whatever its size, so a shared or default id that sends a large share
of all messages is spread over as many tasks as it has steps. What crosses a part's edge is carried by
one summary row per part; a vessel has at most one for each step of the time that the table covers.

Rows without an id belong to no vessel: per-vessel operators leave them out (``without_id`` has them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wakeline.functions.timefn import epoch_seconds
from wakeline.schema import BROADCAST_ROWS, PART_SECONDS
from wakeline.sources.scratch import materialise

# Rows without a time come first, in a part of their own.
_NO_TIME = -(1 << 62)


def with_part(df: DataFrame, seconds: int = PART_SECONDS) -> DataFrame:
    """Messages that have an id, with ``part``: the number of their time step since 1970."""
    step = F.floor(epoch_seconds(F.col("base_dt")) / seconds).cast("bigint")
    return df.where(F.col("mmsi").isNotNull()).withColumn("part", F.coalesce(step, F.lit(_NO_TIME)))


def without_id(df: DataFrame) -> DataFrame:
    """The messages that per-vessel operators leave out."""
    return df.where(F.col("mmsi").isNull())


def part_places(points: DataFrame, *keys: str) -> DataFrame:
    """(keys, part, first_idx, n_points, before_dt): for each part the number of points before it, the
    number of points in all, and the newest time of the parts before it. Counts are partial
    aggregates, and only they are put in order."""
    sizes = points.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("_n"), F.max("base_dt").alias("_last"))
    along = W.partitionBy(*keys).orderBy("part")
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    return sizes.select(
        *keys,
        "part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("bigint").alias("first_idx"),
        F.sum("_n").over(W.partitionBy(*keys)).cast("bigint").alias("n_points"),
        F.last("_last", ignorenulls=True).over(earlier).alias("before_dt"),
    )


def attach_per_vessel(df: DataFrame, per_vessel: DataFrame, how: str = "inner") -> DataFrame:
    """Joins one row per vessel to messages with ``part``. The rows are stored and counted: up to
    ``BROADCAST_ROWS`` the messages stay where they are, beyond that both sides meet on
    (mmsi, part), so that a large vessel is not joined in one task."""
    stored = materialise(per_vessel, "per-vessel")
    if stored.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(stored), "mmsi", how)
    parts = df.select("mmsi", "part").distinct()
    return df.join(parts.join(stored, "mmsi"), ["mmsi", "part"], how)
