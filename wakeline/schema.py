"""Schemas, default parameters and fixed value tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw position message. Timestamps hold the UTC wall clock and carry no zone, so
# results do not depend on the session time zone.
AIS = T.StructType(
    [
        T.StructField("mmsi", T.IntegerType()),
        T.StructField("base_dt", T.TimestampNTZType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("sog", T.FloatType()),
        T.StructField("cog", T.FloatType()),
        T.StructField("heading", T.FloatType()),
        T.StructField("vessel_name", T.StringType()),
        T.StructField("imo", T.StringType()),
        T.StructField("call_sign", T.StringType()),
        T.StructField("vessel_type", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("l", T.FloatType()),
        T.StructField("w", T.FloatType()),
        T.StructField("draft", T.FloatType()),
        T.StructField("cargo", T.IntegerType()),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("mmsi", T.IntegerType()),
        T.StructField("vessel_type", T.IntegerType()),
        T.StructField("vessel_name", T.StringType()),
        T.StructField("imo", T.StringType()),
        T.StructField("call_sign", T.StringType()),
        T.StructField("cargo", T.IntegerType()),
        T.StructField("l", T.DoubleType()),
        T.StructField("w", T.DoubleType()),
        T.StructField("draft", T.DoubleType()),
    ]
)
# The same with the group: the type goes by another name there.
GROUPED_METADATA = T.StructType(
    [T.StructField("vessel_code" if f.name == "vessel_type" else f.name, f.dataType) for f in METADATA.fields]
    + [T.StructField("vessel_group", T.StringType())]
)

MOTION_COLUMNS = ("mmsi", "status", "base_dt", "lat", "lon", "sog", "cog", "heading")
ATTRIBUTE_COLUMNS = (
    "mmsi", "vessel_type", "vessel_name", "imo", "call_sign", "l", "w", "draft", "cargo",
)
FIRST_KNOWN_COLUMNS = ("vessel_type", "vessel_name", "imo", "call_sign", "cargo")
MEAN_COLUMNS = ("l", "w", "draft")

# Whole seconds of ``base_dt`` and ``localtime``, stored next to them: Parquet statistics
# are used for integers but not for zone-free timestamps.
BASE_SECONDS, LOCAL_SECONDS = "base_s", "local_s"

# --- defaults -------------------------------------------------------------------------

LAT_MIN, LAT_MAX = 47.0, 49.45
LON_MIN, LON_MAX = -123.75, -122.0
ZONE = "America/Los_Angeles"
SAMPLE_START, SAMPLE_END = "2017-10-01 00:00:00", "2018-01-01 00:00:00"

MOVING_KNOTS = 4.0
IN_MOTION_KNOTS = 1.0
GAP_SECONDS = 120
RADIUS_MILES = 3.0
HORIZON_MINUTES = 5
KNOTS_TO_MPH = 1.15078
RETENTION_SECONDS = 3600
MINUTE_SECONDS = 60
HOUR_SECONDS = 3600
QUINTILES = (0.2, 0.4, 0.6, 0.8)
MARKER_LAT, MARKER_LON = 0.0010, 0.0015

EARTH_RADIUS_MILES = 3958.7613
KM_PER_MILE = 1.609344
# Unit -> how many make a mile, and the name of a distance column in it.
UNITS = {"mi": (1.0, "miles"), "km": (KM_PER_MILE, "kilometres"), "m": (KM_PER_MILE * 1000, "metres"), "ft": (5280.0, "feet")}
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
GEOHASH_LAT_LIMIT = 85.05112878

# Vessels are cut into parts of this time step, so that no task and no array ever has to
# hold one vessel whole. Results do not depend on it.
PART_SECONDS = 3600
# Tables up to this many short rows (about 100 MB in memory) may be broadcast; every use
# counts the rows first and has a shuffle join for the larger case.
BROADCAST_ROWS = 1_000_000
# Positions per (slot, grid cell) above which the cell is spread over several tasks.
CELL_ROWS = 2_000

# --- fixed values ---------------------------------------------------------------------

# Vessel group -> type codes, in order of priority.
VESSEL_GROUPS = {
    "pleasure": [36, 37, 1019],
    "publicService": [*range(50, 60), 1018],
    "passenger": [*range(60, 70), 1012, 1013, 1014, 1015],
    "cargo": [*range(70, 80), 1003, 1004, 1016],
    "tanker": [*range(80, 90), 1017, 1024],
    "fishing": [30, 1001, 1002],
    "tugTow": [21, 22, 31, 32, 52, 1023, 1025],
    "military": [35, 1021],
    "research": [1020],
}
UNKNOWN = "unknown"
GROUP_NAMES = (*VESSEL_GROUPS, UNKNOWN)

# Display colours per vessel group and per speed class (slow to fast).
GROUP_COLOURS = {
    "pleasure": "#008695",
    "publicService": "red",
    "passenger": "#11A579",
    "cargo": "#CF1C90",
    "tanker": "#F2B701",
    "fishing": "#E5FFFF",
    "tugTow": "#E68310",
    "military": "olive",
    "research": "violet",
    "unknown": "white",
}
SPEED_COLOURS = ("cyan", "orange", "green", "purple", "red")

# Chart object codes of the polygon layer.
POLYGON_CLASSES = {
    "96": "precautionary_area",
    "150": "separation_scheme",
    "148": "lane",
    "152": "lane",
}

MISSING_NUMBER = -999.0
DOC_PREFIX = "meta_"
