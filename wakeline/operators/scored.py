"""Radius searches on positions that are stored in the order of their geohash score.

The score interleaves the bits of latitude and longitude, so a cell of the grid at any depth is one range of scores. A circle is
covered by the few cells of about its own size that its bounding box touches; neighbouring cells join to longer ranges. The
ranges are plain comparisons of a stored integer column, by which a scan leaves out row groups and files; distances decide among what is left.
"""

from __future__ import annotations

from functools import reduce
from math import asin, cos, degrees, floor, radians, sin
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geofn import haversine
from wakeline.operators.geosets import with_score
from wakeline.schema import EARTH_RADIUS_MILES, GEOHASH_LAT_LIMIT, RADIUS_MILES

#: Bits of a score for each of its two axes.
AXIS_BITS = 26


def write_by_score(positions: DataFrame, path: str) -> None:
    """Positions with ``score`` in files that follow each other in it; those without coordinates have no score and come first."""
    ranges = ["score", *[c for c in ("mmsi", "base_dt") if c in positions.columns]]
    with_score(positions).repartitionByRange(*ranges).sortWithinPartitions(*ranges).write.parquet(path)


def _interleaved(lat_cell: int, lon_cell: int, bits: int) -> int:
    score = 0
    for i in range(bits):
        score |= (lat_cell >> i & 1) << 2 * i | (lon_cell >> i & 1) << 2 * i + 1
    return score


def score_ranges(lat: float, lon: float, miles: float, earth: float = EARTH_RADIUS_MILES) -> list[tuple[int, int]]:
    """Disjoint ranges (first, last) of scores, ascending, that hold every position within ``miles`` of the point."""
    reach = degrees(miles / earth) * (1 + 1e-9) + 1e-9
    span = 180.0
    if abs(lat) + reach < 90:
        span = min(180.0, degrees(asin(min(1.0, sin(radians(reach)) / cos(radians(lat))))) * (1 + 1e-9) + 1e-9)
    limit = GEOHASH_LAT_LIMIT
    # The deepest grid whose cells are at least half as high and wide as the circle's radius.
    bits = AXIS_BITS
    while bits and (2 * limit / (1 << bits) < reach / 2 or 360 / (1 << bits) < span / 2):
        bits -= 1
    cells = 1 << bits

    def row(value: float) -> int:
        return min(cells - 1, max(0, floor((value + limit) / (2 * limit) * cells)))

    rows = range(row(lat - reach), row(lat + reach) + 1)
    first, last = (floor((lon + side + 180) / 360 * cells) for side in (-span, span))
    columns = {c % cells for c in range(first, min(last, first + cells - 1) + 1)}
    # A longitude of 180 degrees and more is stored in the last column.
    columns |= {cells - 1} if lon + span >= 180 else set()
    shift = 2 * (AXIS_BITS - bits)
    found: list[tuple[int, int]] = []
    for prefix in sorted(_interleaved(y, x, bits) for y in rows for x in columns):
        low, high = prefix << shift, (prefix + 1 << shift) - 1
        if found and found[-1][1] + 1 == low:
            found[-1] = (found[-1][0], high)
        else:
            found.append((low, high))
    return found


def within_radius_by_score(
    stored: DataFrame, lat: float, lon: float, miles: float = RADIUS_MILES, earth: float = EARTH_RADIUS_MILES
) -> DataFrame:
    """``within_radius_of_point`` on a table with ``score`` (``write_by_score``): reads the ranges that cover the circle."""
    near = reduce(or_, (F.col("score").between(low, high) for low, high in score_ranges(lat, lon, miles, earth)))
    away = haversine(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"), earth)
    return stored.where(near).withColumn("miles", away).where(F.col("miles") <= miles)
