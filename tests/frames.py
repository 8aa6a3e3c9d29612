"""Small frames for the tests."""

from datetime import datetime, timedelta

SCHEMA = (
    "seq bigint, mmsi int, base_dt timestamp_ntz, lat double, lon double, sog double, cog double, "
    "heading double, status string"
)
START = datetime(2017, 11, 3, 17, 0, 0)


def track(spark, mmsi, steps, start=START, first_seq=0, lat=48.0, lon=-122.5):
    """Messages of one vessel from (seconds after start, speed)."""
    return spark.createDataFrame(
        [
            (first_seq + i, mmsi, start + timedelta(seconds=s), lat + i / 1000, lon, sog, 90.0, None, None)
            for i, (s, sog) in enumerate(steps)
        ],
        SCHEMA,
    )


def positions(spark, points):
    """(mmsi, lat, lon, sog) rows at one time."""
    return spark.createDataFrame(
        [(i, m, START, lat, lon, sog, 0.0, None, None) for i, (m, lat, lon, sog) in enumerate(points)], SCHEMA
    )
