"""Position time series: long form, retention, ranges, last-hour lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.timefn import epoch_millis, more_than
from wakeline.operators.parts import attach_per_vessel, with_part
from wakeline.operators.tracks import build_tracks
from wakeline.schema import PART_SECONDS, RETENTION_SECONDS
from wakeline.sources.scratch import materialise


def long_series(df: DataFrame) -> DataFrame:
    """(mmsi, label, ts_ms, value): two samples per message. ``ts_ms`` is the local wall
    clock in milliseconds, as the map tools expect it."""
    keep = [c for c in ("base_dt", "seq") if c in df.columns]
    return df.select(
        "mmsi",
        *keep,
        epoch_millis(F.col("localtime")).alias("ts_ms"),
        F.expr("stack(2, 'Lat', lat, 'Lon', lon) as (label, value)"),
    )


def series_range(series: DataFrame, mmsi: int, label: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Samples of one series in time order; ``end`` None is open."""
    rows = series.where((F.col("mmsi") == mmsi) & (F.col("label") == label) & (F.col("ts_ms") >= start))
    if end is not None:
        rows = rows.where(F.col("ts_ms") <= end)
    return rows.orderBy(*_in_time(series))


def _in_time(series: DataFrame) -> list[str]:
    """The local clock repeats an hour a year: UTC comes first where the series has it."""
    return [c for c in ("base_dt", "seq", "ts_ms") if c in series.columns]


def latest_samples(series: DataFrame) -> DataFrame:
    """Last sample of each series."""
    return (
        series.groupBy("mmsi", "label")
        .agg(F.max_by(F.struct("ts_ms", "value"), F.struct(*_in_time(series))).alias("_last"))
        .select("mmsi", "label", "_last.*")
    )


def retain(df: DataFrame, seconds: int = RETENTION_SECONDS) -> DataFrame:
    """Messages no older than ``seconds`` before the vessel's newest one. The newest time
    is a partial aggregate joined back, so no task sorts a vessel whole."""
    newest = df.where(F.col("mmsi").isNotNull()).groupBy("mmsi").agg(F.max("base_dt").alias("_newest"))
    joined = attach_per_vessel(with_part(df), newest)
    return joined.where(~more_than(F.col("_newest"), F.col("base_dt"), seconds)).select(*df.columns)


def of_vessels(df: DataFrame, vessels: DataFrame) -> DataFrame:
    """Messages of the given vessels."""
    return df.join(vessels.select("mmsi"), "mmsi", "left_semi")


def last_hour_lines(hour: DataFrame, moving: DataFrame, seconds: int = PART_SECONDS) -> DataFrame:
    """The track of the last hour of every vessel that is moving now. The hour is stored
    first: it is small next to the table it comes from, and is counted and then read."""
    return build_tracks(materialise(of_vessels(hour, moving), "last-hour"), seconds)
