"""Message-level projections, filters, local time and snapshots."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.timefn import day_number, localtime, ntz
from wakeline.schema import (
    ATTRIBUTE_COLUMNS,
    BASE_SECONDS,
    IN_MOTION_KNOTS,
    LAT_MAX,
    LAT_MIN,
    LOCAL_SECONDS,
    LON_MAX,
    LON_MIN,
    MINUTE_SECONDS,
    MOTION_COLUMNS,
    MOVING_KNOTS,
    SAMPLE_END,
    SAMPLE_START,
    ZONE,
)


def order_key(df: DataFrame, time: str = "base_dt") -> list[str]:
    """Columns that put the messages of a vessel in one fixed order: ``seq`` breaks ties
    where the source has it, the reported values do otherwise."""
    ties = ["seq"] if "seq" in df.columns else ["lat", "lon", "sog", "cog"]
    return [time, *[c for c in ties if c in df.columns]]


def motion_columns(ais: DataFrame) -> DataFrame:
    return ais.select(*MOTION_COLUMNS, *[c for c in ("seq",) if c in ais.columns])


def attribute_columns(ais: DataFrame) -> DataFrame:
    return ais.select(*ATTRIBUTE_COLUMNS)


def clean_speeds(df: DataFrame) -> DataFrame:
    """Float speeds, courses and headings to doubles with the one decimal they were sent
    with, so that 4.1 compares as 4.1."""
    return df.withColumns(
        {c: F.round(F.col(c).cast("double"), 1) for c in ("sog", "cog", "heading") if c in df.columns}
    )


def in_box(
    df: DataFrame,
    lat_min: float = LAT_MIN,
    lat_max: float = LAT_MAX,
    lon_min: float = LON_MIN,
    lon_max: float = LON_MAX,
) -> DataFrame:
    """Inclusive box; a row without a position is out."""
    return df.where(F.col("lat").between(lat_min, lat_max) & F.col("lon").between(lon_min, lon_max))


def with_localtime(df: DataFrame, zone: str = ZONE) -> DataFrame:
    return df.withColumn("localtime", localtime(F.col("base_dt"), zone))


def with_calendar(df: DataFrame, zone: str = ZONE) -> DataFrame:
    """Local time and its year, month, day and day of week (1 = Sunday)."""
    local = F.col("localtime")
    return with_localtime(df, zone).withColumns(
        {
            "year": F.year(local),
            "month": F.month(local),
            "day": F.dayofmonth(local),
            "dow": F.dayofweek(local),
        }
    )


def on_days(first: Column, last: Column) -> Column:
    """Predicate on the partition columns ``year, month, day`` alone, so the scan can
    drop whole directories; the bounds are literals and fold away."""

    def number(ts):
        return day_number(F.year(ts), F.month(ts), F.dayofmonth(ts))

    return day_number(F.col("year"), F.col("month"), F.col("day")).between(number(first), number(last))


# No zone is farther from UTC.
_ZONES = timedelta(hours=15)


def _seconds_within(df: DataFrame, column: str, start: datetime, end: datetime) -> DataFrame:
    """Range on the stored seconds, if the table has them: skips files and row groups. It
    only widens to whole seconds, so the exact test on the timestamp must follow."""
    if column not in df.columns:
        return df
    first, last = ((t - datetime(1970, 1, 1)) // timedelta(seconds=1) for t in (start, end))
    return df.where(F.col(column).between(first, last))


def snapshot(df: DataFrame, at: datetime, width: timedelta = timedelta(seconds=MINUTE_SECONDS)) -> DataFrame:
    """Rows with local time in ``(at - width, at]``, whatever days that touches. On a table
    with day columns only the days in question are read; a table in UTC order is narrowed by its
    stored seconds first, as wide as any zone can be from UTC."""
    start, end = ntz(at - width), ntz(at)
    rows = _seconds_within(df, LOCAL_SECONDS, at - width, at)
    rows = _seconds_within(rows, BASE_SECONDS, at - width - _ZONES, at + _ZONES)
    rows = rows.where((F.col("localtime") > start) & (F.col("localtime") <= end))
    return _days_within(rows, start, end)


def _days_within(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """Range on the day columns, if the table has them."""
    return df.where(on_days(first, last)) if {"year", "month", "day"} <= set(df.columns) else df


def near_place_and_time(
    df: DataFrame,
    start: datetime,
    end: datetime,
    lat_min: float,
    lat_max: float,
    lon_min: float,
    lon_max: float,
    zone: str = ZONE,
) -> DataFrame:
    """Messages in a UTC time range and a box, reading only the local days it touches."""
    first, last = ntz(start), ntz(end)
    rows = _seconds_within(df, BASE_SECONDS, start, end)
    rows = _days_within(rows, localtime(first, zone), localtime(last, zone))
    return in_box(rows.where(F.col("base_dt").between(first, last)), lat_min, lat_max, lon_min, lon_max)


def sample_period(df: DataFrame, start: str = SAMPLE_START, end: str = SAMPLE_END) -> DataFrame:
    """Local time in ``[start, end)``; the three-month sample by default."""
    first, last = datetime.fromisoformat(start), datetime.fromisoformat(end)
    rows = _days_within(_seconds_within(df, LOCAL_SECONDS, first, last), ntz(start), ntz(end))
    return rows.where((F.col("localtime") >= ntz(start)) & (F.col("localtime") < ntz(end)))


def moving(df: DataFrame, knots: float = MOVING_KNOTS) -> DataFrame:
    return df.where(F.col("sog") >= knots)


def stationary(df: DataFrame, knots: float = MOVING_KNOTS) -> DataFrame:
    return df.where(F.col("sog") < knots)


def in_motion(df: DataFrame, knots: float = IN_MOTION_KNOTS) -> DataFrame:
    return df.where(F.col("sog") >= knots)


def sort_by_time(df: DataFrame) -> DataFrame:
    return df.orderBy(*order_key(df))


def random_anchor(df: DataFrame, seed: int) -> DataFrame:
    """One observed local time, picked by a seeded hash: the same for the same data."""
    times = df.select("localtime").where(F.col("localtime").isNotNull()).distinct()
    rank = F.md5(F.concat(F.col("localtime").cast("string"), F.lit(f":{seed}")))
    return times.orderBy(rank, "localtime").limit(1)


def random_vessels(df: DataFrame, seed: int, count: int = 10) -> DataFrame:
    """``count`` different vessels in seeded random order."""
    rank = F.md5(F.concat(F.col("mmsi").cast("string"), F.lit(f":{seed}")))
    return df.select("mmsi").distinct().orderBy(rank, "mmsi").limit(count)
