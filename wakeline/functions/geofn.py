"""Geometry on Columns: distances, destinations, geohash scores and search cells."""

from __future__ import annotations

from math import degrees, pi, radians, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.schema import (
    EARTH_RADIUS_MILES,
    GEOHASH_LAT_LIMIT,
    HORIZON_MINUTES,
    KM_PER_MILE,
    KNOTS_TO_MPH,
    WGS84_A,
    WGS84_F,
)


def knots_to_mph(knots: Column) -> Column:
    return knots * KNOTS_TO_MPH


def horizon_miles(sog: Column, minutes: float = HORIZON_MINUTES) -> Column:
    """Miles covered in ``minutes`` at ``sog`` knots."""
    return sog * minutes / 60 * KNOTS_TO_MPH


def haversine(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_RADIUS_MILES
) -> Column:
    """Great-circle distance in the unit of ``radius``."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Opposite points can round to h > 1, which has no arc sine; they are half a turn apart.
    return F.nanvl(F.asin(F.sqrt(h)), F.lit(pi / 2)) * (2 * radius)


def _wrap(lon: Column) -> Column:
    return F.when((lon >= -180) & (lon < 180), lon).otherwise(F.pmod(lon + 180, F.lit(360.0)) - 180)


def with_destination(
    df: DataFrame,
    miles: Column,
    lat: str = "lat",
    lon: str = "lon",
    bearing: str = "cog",
    model: str = "wgs84",
    radius: float = EARTH_RADIUS_MILES,
) -> DataFrame:
    """Adds ``dest_lat, dest_lon``: the point ``miles`` away along ``bearing`` (degrees).

    ``sphere`` is the closed form; ``wgs84`` is Vincenty's direct solution with three
    rounds. Each intermediate is its own projected column so that generated code stays
    small and nothing is evaluated twice. The result passes through a one-row generator:
    filters on other columns still move down to the scan, while a filter on the
    destination stays above instead of being unfolded into thousands of terms.
    """
    if model == "sphere":
        return _sphere_destination(df, miles, lat, lon, bearing, radius)
    if model == "wgs84":
        return _ellipsoid_destination(df, miles, lat, lon, bearing)
    raise ValueError(f"unknown earth model {model!r}")


def _sphere_destination(df, miles, lat, lon, bearing, radius):
    c = F.col
    staged = df.withColumns(
        {
            "_phi": F.radians(c(lat)),
            "_theta": F.radians(c(bearing)),
            "_delta": miles / radius,
        }
    )
    staged = staged.withColumn(
        "_phi2",
        F.asin(
            F.sin(c("_phi")) * F.cos(c("_delta"))
            + F.cos(c("_phi")) * F.sin(c("_delta")) * F.cos(c("_theta"))
        ),
    )
    turn = F.atan2(
        F.sin(c("_theta")) * F.sin(c("_delta")) * F.cos(c("_phi")),
        F.cos(c("_delta")) - F.sin(c("_phi")) * F.sin(c("_phi2")),
    )
    return _landed(df, staged, F.degrees(c("_phi2")), c(lon) + F.degrees(turn))


def _landed(df, staged, dest_lat, dest_lon):
    spot = F.struct(dest_lat.alias("dest_lat"), dest_lon.alias("_east"))
    landed = staged.select(*df.columns, F.inline(F.array(spot)))
    return landed.withColumn("dest_lon", _wrap(F.col("_east"))).drop("_east")


def _ellipsoid_destination(df, miles, lat, lon, bearing):
    c = F.col
    f, a = WGS84_F, WGS84_A
    b = a * (1 - f)
    metres = miles * (KM_PER_MILE * 1000)

    staged = df.withColumns(
        {
            "_sin_a1": F.sin(F.radians(c(bearing))),
            "_cos_a1": F.cos(F.radians(c(bearing))),
            "_u1": F.atan(F.tan(F.radians(c(lat))) * (1 - f)),
        }
    )
    staged = staged.withColumns({"_sin_u1": F.sin(c("_u1")), "_cos_u1": F.cos(c("_u1"))})
    staged = staged.withColumns(
        {
            "_sigma1": F.atan2(F.tan(c("_u1")), c("_cos_a1")),
            "_sin_a": c("_cos_u1") * c("_sin_a1"),
        }
    )
    staged = staged.withColumn("_cos2_a", 1 - c("_sin_a") * c("_sin_a"))
    staged = staged.withColumn("_u2", c("_cos2_a") * ((a * a - b * b) / (b * b)))
    staged = staged.withColumns(
        {
            "_big_a": 1
            + c("_u2") / 16384 * (4096 + c("_u2") * (-768 + c("_u2") * (320 - 175 * c("_u2")))),
            "_big_b": c("_u2") / 1024 * (256 + c("_u2") * (-128 + c("_u2") * (74 - 47 * c("_u2")))),
        }
    )
    staged = staged.withColumn("_arc", metres / (b * c("_big_a")))
    staged = staged.withColumn("_sigma", c("_arc"))
    for _ in range(3):
        staged = staged.withColumns(
            {
                "_cos_2m": F.cos(2 * c("_sigma1") + c("_sigma")),
                "_sin_s": F.sin(c("_sigma")),
                "_cos_s": F.cos(c("_sigma")),
            }
        )
        inner = c("_cos_s") * (2 * c("_cos_2m") * c("_cos_2m") - 1) - c("_big_b") / 6 * c(
            "_cos_2m"
        ) * (4 * c("_sin_s") * c("_sin_s") - 3) * (4 * c("_cos_2m") * c("_cos_2m") - 3)
        staged = staged.withColumn(
            "_sigma",
            c("_arc") + c("_big_b") * c("_sin_s") * (c("_cos_2m") + c("_big_b") / 4 * inner),
        )
    staged = staged.withColumns(
        {
            "_cos_2m": F.cos(2 * c("_sigma1") + c("_sigma")),
            "_sin_s": F.sin(c("_sigma")),
            "_cos_s": F.cos(c("_sigma")),
        }
    )
    staged = staged.withColumns(
        {
            "_north": c("_sin_u1") * c("_cos_s") + c("_cos_u1") * c("_sin_s") * c("_cos_a1"),
            "_rest": c("_sin_u1") * c("_sin_s") - c("_cos_u1") * c("_cos_s") * c("_cos_a1"),
            "_lambda": F.atan2(
                c("_sin_s") * c("_sin_a1"),
                c("_cos_u1") * c("_cos_s") - c("_sin_u1") * c("_sin_s") * c("_cos_a1"),
            ),
            "_big_c": f / 16 * c("_cos2_a") * (4 + f * (4 - 3 * c("_cos2_a"))),
        }
    )
    shift = c("_sigma") + c("_big_c") * c("_sin_s") * (
        c("_cos_2m") + c("_big_c") * c("_cos_s") * (2 * c("_cos_2m") * c("_cos_2m") - 1)
    )
    return _landed(
        df,
        staged,
        F.degrees(
            F.atan2(c("_north"), (1 - f) * F.sqrt(c("_sin_a") * c("_sin_a") + c("_rest") * c("_rest")))
        ),
        c(lon) + F.degrees(c("_lambda") - (1 - c("_big_c")) * f * c("_sin_a") * shift),
    )


# --- geohash --------------------------------------------------------------------------

GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _axis_bits(value: Column, limit: float) -> Column:
    cell = F.floor((value + limit) / (2 * limit) * (1 << 26)).cast("bigint")
    return F.greatest(F.lit(0).cast("bigint"), F.least(cell, F.lit((1 << 26) - 1).cast("bigint")))


def _spread(bits: Column) -> Column:
    """Puts a zero before every bit: binary digits read as base-4 digits."""
    return F.conv(F.bin(bits), 4, 10).cast("bigint")


def geohash_score(lat: Column, lon: Column, lat_limit: float = GEOHASH_LAT_LIMIT) -> Column:
    """52-bit interleave of 26 latitude bits (even places) and 26 longitude bits."""
    known = lat.isNotNull() & lon.isNotNull()
    score = _spread(_axis_bits(lat, lat_limit)).bitwiseOR(
        F.shiftleft(_spread(_axis_bits(lon, 180.0)), 1)
    )
    return F.when(known, score)


def geohash_text(lat: Column, lon: Column, length: int = 10) -> Column:
    """Base-32 geohash, up to 10 characters (50 of the 52 bits)."""
    if not 1 <= length <= 10:
        raise ValueError("length must be 1..10")
    bits = F.shiftright(geohash_score(lat, lon, lat_limit=90.0), 52 - 5 * length)
    digits = F.lpad(F.conv(bits, 10, 32), length, "0")
    return F.translate(digits, BASE32_DIGITS, GEOHASH_ALPHABET)


# --- search cells ---------------------------------------------------------------------
# The earth is cut into latitude bands one search radius high, and each band into cells
# about one radius wide. A point is stored in one cell; a search touches the cells its
# circle can reach, worked out from the circle's own bounding box, so the result is exact
# at every latitude and across the 180th meridian.

_MARGIN = 1 + 1e-9


def cell_height(radius_miles: float, earth: float = EARTH_RADIUS_MILES) -> float:
    """Height of a band in degrees."""
    return degrees(radius_miles / earth)


def cell_band(lat: Column, height: float) -> Column:
    return F.floor((lat + 90) / height).cast("int")


def _cells_in_band(band: Column, height: float) -> Column:
    middle = F.radians((band + 0.5) * height - 90)
    return F.greatest(F.lit(1), F.floor(F.cos(middle) * (360 / height)).cast("int"))


def _raw_cell(lon: Column, count: Column) -> Column:
    return F.floor((lon + 180) / 360 * count).cast("int")


def cell_in_band(lon: Column, band: Column, height: float) -> Column:
    count = _cells_in_band(band, height)
    return F.pmod(_raw_cell(lon, count), count)


def bands_reached(lat: Column, height: float, upward_only: bool = False) -> Column:
    low = lat if upward_only else lat - height * _MARGIN
    return F.sequence(cell_band(low, height), cell_band(lat + height * _MARGIN, height))


def cells_reached(lat: Column, lon: Column, band: Column, height: float) -> Column:
    """Cells of ``band`` that a circle of one band height around the point can touch."""
    reach = height * _MARGIN
    count = _cells_in_band(band, height)
    span = F.when(F.abs(lat) + reach >= 90, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), sin(radians(reach)) / F.cos(F.radians(lat)))))
        * _MARGIN
    )
    first, last = _raw_cell(lon - span, count), _raw_cell(lon + span, count)
    around = F.when(last - first + 1 >= count, F.sequence(F.lit(0), count - 1)).otherwise(
        F.transform(F.sequence(first, last), lambda x: F.pmod(x, count))
    )
    return around
