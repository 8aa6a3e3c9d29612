"""Messages near many places and times at once.

Each probe is a box and a closed UTC interval. Probes go into bins of time and place whose size follows the
probe's own (a few fixed levels), so a probe covers a few bins in each direction, a message falls into one bin a
level, and both meet in an equi-join. The bins are a quarter of the probe's size or more, but no more than its size: of the
messages in them about a third lie inside. On a table with day columns the scan drops all day folders that no probe touches; where
the probes are broadcast the join also holds the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.timefn import epoch_seconds, localtime
from wakeline.schema import BROADCAST_ROWS, CELL_ROWS, ZONE
from wakeline.sources.scratch import materialise

#: Bin sizes by level: seconds, and degrees of latitude and longitude. The last ones hold any interval and any box.
TIME_BINS = (60, 240, 960, 3_840, 15_360, 61_440, 245_760, 983_040, 10_000 * 365 * 86_400)
PLACE_BINS = (0.02, 0.08, 0.32, 1.28, 5.12, 360.0)
#: Bins that fit into a probe's size in one direction, at most.
PARTS = 4
DAY_COLUMNS = ("year", "month", "day")
_PROBE = ("probe_id", "start", "end", "lat_min", "lat_max", "lon_min", "lon_max")


def _level(size: Column, bins: tuple[float, ...]) -> Column:
    """The first level whose bins are no smaller than ``size``."""
    chain = F.lit(len(bins) - 1)
    for number in range(len(bins) - 2, -1, -1):
        chain = F.when(size <= bins[number], number).otherwise(chain)
    return chain


def _bin(value: Column, bins: tuple[float, ...], level: Column) -> Column:
    size = F.element_at(F.array(*(F.lit(float(b)) for b in bins)), level + 1)
    return F.floor(value / size).cast("bigint")


def binned_probes(probes: DataFrame, parts: int = 1) -> DataFrame:
    """One row for each bin that a probe covers, ``parts`` + 1 in each direction at most; probes with an empty interval or box, or a
    missing bound, have none."""
    known = probes.select(*_PROBE).where(
        (F.col("end") >= F.col("start")) & (F.col("lat_max") >= F.col("lat_min")) & (F.col("lon_max") >= F.col("lon_min"))
    )
    first, last = epoch_seconds(F.col("start")), epoch_seconds(F.col("end"))
    height, width = F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min")
    size = F.greatest(height, width)
    levels = known.withColumns({"_t": _level((last - first) / parts, TIME_BINS), "_p": _level(size / parts, PLACE_BINS)})

    def covered(low: Column, high: Column, bins: tuple[float, ...], level: str) -> Column:
        return F.explode(F.sequence(_bin(low, bins, F.col(level)), _bin(high, bins, F.col(level))))

    return (
        levels.withColumn("_tb", covered(first, last, TIME_BINS, "_t"))
        .withColumn("_yb", covered(F.col("lat_min"), F.col("lat_max"), PLACE_BINS, "_p"))
        .withColumn("_xb", covered(F.col("lon_min"), F.col("lon_max"), PLACE_BINS, "_p"))
    )


def _days(zone: str) -> tuple[Column, Column]:
    """First and last local day that a probe's interval can touch; a clock change moves a time by no more than an hour."""
    hour = F.expr("INTERVAL 1 HOUR")
    return F.to_date(localtime(F.col("start") - hour, zone)), F.to_date(localtime(F.col("end") + hour, zone))


def probe_days(binned: DataFrame, zone: str = ZONE) -> DataFrame:
    """Adds the local days that the interval can touch."""
    days = binned.withColumn("_day", F.explode(F.sequence(*_days(zone), F.expr("INTERVAL 1 DAY"))))
    return days.withColumns({"year": F.year("_day"), "month": F.month("_day"), "day": F.dayofmonth("_day")}).drop("_day")


def _dealt(at: DataFrame, stored: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Messages, probes and join keys: the probes of a bin that holds more than ``CELL_ROWS`` are dealt over shares, so that no
    task holds more of them at once; its messages visit every share."""
    count = F.ceil(F.col("_c") / CELL_ROWS).cast("int").alias("_shares")
    crowded = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > CELL_ROWS).select(*keys, count)
    crowded = materialise(crowded, "crowded-bins")
    held = crowded.count()
    if not held:
        return at, stored, keys
    shares = F.broadcast(crowded) if held <= BROADCAST_ROWS else crowded
    count = F.coalesce("_shares", F.lit(1))
    share = F.pmod(F.xxhash64("probe_id", "start", "end", "lat_min", "lon_min"), count).cast("int")
    stored = stored.join(shares, keys, "left").withColumn("_share", share).drop("_shares")
    at = at.join(shares, keys, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), count - 1))).drop("_shares")
    return at, stored, [*keys, "_share"]


def near_places_and_times(df: DataFrame, probes: DataFrame, zone: str = ZONE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(probe_id, mmsi, base_dt, lat, lon, keep...): the messages inside each probe's box and interval, bounds included.

    ``probes`` has probe_id, start, end (UTC wall clock) and lat_min, lat_max, lon_min, lon_max. They are stored and counted:
    up to ``BROADCAST_ROWS`` bins (and days) are broadcast, more are shuffled. Messages without time or position are near nothing."""
    dated = set(DAY_COLUMNS) <= set(df.columns)
    stored = materialise(binned_probes(probes, PARTS), "probes")
    levels = [(r["_t"], r["_p"]) for r in stored.select("_t", "_p").distinct().collect()]  # at most 54
    first, last = _days(zone)
    each_day = F.datediff(last, first) + 1 if dated else F.lit(1)
    small = (stored.select(each_day.cast("bigint").alias("n")).agg(F.sum("n")).first()[0] or 0) <= BROADCAST_ROWS
    if dated and small:
        stored = materialise(probe_days(stored, zone), "probe-days")
    # The stored rows all pass; the comparison marks this side as one that selects, which pruning asks for.
    side = stored.where(F.col("end") >= F.col("start"))
    columns = [c for c in dict.fromkeys(["mmsi", "base_dt", "lat", "lon", *keep])]
    days = list(DAY_COLUMNS) if dated else []
    rows = df.select(*dict.fromkeys([*columns, *days])).where("base_dt IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
    if dated and not small:
        spans = stored.select("start", "end").distinct()
        touched = materialise(probe_days(spans, zone).select(*days).distinct(), "probe-days")
        if touched.count() <= BROADCAST_ROWS:
            rows = rows.join(F.broadcast(touched.where("month >= 1")), days, "left_semi")
        rows, days = rows.select(*columns), []
    each = F.array(*(F.struct(F.lit(t).alias("_t"), F.lit(p).alias("_p")) for t, p in levels))
    each = each if levels else F.array().cast("array<struct<_t: int, _p: int>>")
    at = rows.withColumn("_level", F.explode(each)).select(*rows.columns, "_level._t", "_level._p")
    at = at.withColumns(
        {
            "_tb": _bin(epoch_seconds(F.col("base_dt")), TIME_BINS, F.col("_t")),
            "_yb": _bin(F.col("lat"), PLACE_BINS, F.col("_p")),
            "_xb": _bin(F.col("lon"), PLACE_BINS, F.col("_p")),
        }
    )
    keys = ["_t", "_p", "_tb", "_yb", "_xb", *days]
    if small:
        side = F.broadcast(side)
    else:
        at, side, keys = _dealt(at, side, keys)
    joined = at.join(side, keys)
    inside = (
        F.col("base_dt").between(F.col("start"), F.col("end"))
        & F.col("lat").between(F.col("lat_min"), F.col("lat_max"))
        & F.col("lon").between(F.col("lon_min"), F.col("lon_max"))
    )
    return joined.where(inside).select("probe_id", *columns)
