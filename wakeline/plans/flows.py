"""The three flows, end to end. Only paths go through the driver."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from wakeline.operators.geosets import (
    ALL,
    MOVING,
    forecast,
    geo_sets,
    marker_rectangles,
    members,
    nth_member,
    within_radius,
)
from wakeline.operators.motion import clean_speeds, in_box, motion_columns, sample_period, snapshot, with_calendar
from wakeline.operators.series import last_hour_lines, of_vessels
from wakeline.operators.tracks import build_tracks, speed_polylines, speed_segments, track_points
from wakeline.operators.vessels import coloured, grouped_metadata, sort_by_type, vessel_metadata
from wakeline.schema import BASE_SECONDS, HOUR_SECONDS, LOCAL_SECONDS, RADIUS_MILES, ZONE
from wakeline.sources.messages import read_ais_csv, write_metadata_csv
from wakeline.sources.scratch import materialise
from wakeline.sources.tables import write_by_day, write_by_time, write_groups, write_if_absent


def prepare(spark: SparkSession, messages: str | DataFrame, out: str) -> dict[str, str]:
    """Raw messages -> motion table, tracks, metadata.

    The motion table is written once and read back for the tracks, so the second consumer
    scans a pruned columnar table and not the raw text again. Metadata covers all
    messages, not only those in the box.
    """
    ais = read_ais_csv(spark, messages) if isinstance(messages, str) else messages
    paths = {name: f"{out}/{name}" for name in ("motion", "tracks", "metadata")}
    write_by_time(in_box(motion_columns(clean_speeds(ais))), paths["motion"])
    motion = spark.read.parquet(paths["motion"])
    write_if_absent(build_tracks(motion), paths["tracks"])
    write_metadata_csv(sort_by_type(vessel_metadata(ais)), paths["metadata"])
    return paths


def lay_out_by_day(spark: SparkSession, motion_path: str, out_path: str, zone: str = ZONE) -> None:
    """Motion table -> local time, calendar columns, one folder per local day."""
    write_by_day(with_calendar(spark.read.parquet(motion_path), zone), out_path)


def sample(spark: SparkSession, by_day_path: str, messages: DataFrame, out: str) -> dict[str, str]:
    """The three-month sample as files: motion by local day, tracks, and the metadata of its vessels with
    their groups. Only the days of the period are read."""
    paths = {name: f"{out}/{name}" for name in ("motion", "tracks", "metadata")}
    rows = sample_period(spark.read.parquet(by_day_path)).drop(BASE_SECONDS, LOCAL_SECONDS)
    write_by_day(rows, paths["motion"])
    stored = spark.read.parquet(paths["motion"])
    write_if_absent(build_tracks(stored), paths["tracks"])
    known = vessel_metadata(of_vessels(messages, stored.select("mmsi").distinct()))
    write_metadata_csv(sort_by_type(known).transform(grouped_metadata), paths["metadata"])
    return paths


def moving_map(
    spark: SparkSession, by_day_path: str, at: datetime, meta: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """What a map of one moment shows: the moving vessels as marker rectangles, and the points of their last
    hour, both with group and colour."""
    rows = spark.read.parquet(by_day_path)
    moving = materialise(members(geo_sets(snapshot(rows, at), keep=("sog", "cog")), MOVING), "moving")
    hour = snapshot(rows, at, timedelta(seconds=HOUR_SECONDS))
    return coloured(marker_rectangles(moving), meta), coloured(track_points(last_hour_lines(hour, moving)), meta)


def moment(
    spark: SparkSession, by_day_path: str, at: datetime, index: int, miles: float = RADIUS_MILES
) -> tuple[DataFrame, DataFrame]:
    """Around one moving vessel at one moment: (neighbours in the set of all vessels,
    forecasts of all moving vessels)."""
    sets = materialise(geo_sets(snapshot(spark.read.parquet(by_day_path), at), keep=("sog", "cog")), "sets")
    moving = members(sets, MOVING)
    return within_radius(members(sets, ALL), nth_member(moving, index), miles), forecast(moving)


def group_and_segment(
    spark: SparkSession, motion_path: str, tracks_path: str, meta: DataFrame, period: str, out_path: str
) -> DataFrame:
    """Tracks per vessel group on disk, and the speed polylines of all vessels."""
    write_groups(spark.read.parquet(tracks_path), meta, period, out_path)
    return speed_polylines(speed_segments(spark.read.parquet(motion_path), before=True))
