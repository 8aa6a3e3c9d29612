"""Position messages and polygons derived from the test tables.

The test data has no ship positions, so each row of ``events`` becomes one message (30
days squeezed into four hours around the end of daylight saving time) and each row of
``part`` one polygon. Everything grows with those tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schema import LAT_MAX, LAT_MIN, LON_MAX, LON_MIN

# Type codes dealt out by user id; the one missing value stands for an unknown type.
TYPE_CODES = (
    36, 37, 1019, 50, 52, 1018, 60, 1012, 70, 1003, 80, 1024, 30, 1001, 21, 31, 1023, 35, 1020, None, 33,
)
OBJECT_CODES = ("96", "150", "148", "152", "30")
TIME_START = "TIMESTAMP_NTZ'2017-11-05 06:00:00'"
SOURCE_START = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"

# A quarter of the messages lies between two seconds.
HALF = "CASE WHEN event_id % 4 = 1 THEN INTERVAL '0.5' SECOND ELSE INTERVAL '0' SECOND END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages_from(events: DataFrame) -> DataFrame:
    """All message columns but ``vessel_name``, from rows shaped like ``events``."""
    seconds = f"cast(cast(ts - {SOURCE_START} AS interval second) AS bigint) div 180"
    codes = ", ".join("NULL" if c is None else str(c) for c in TYPE_CODES)
    return (
        events.withColumn("code", F.expr(f"get(array({codes}), cast(user_id % 21 AS int))"))
        .selectExpr(
            "event_id AS seq",
            "user_id",
            "cast(366000000 + user_id AS int) AS mmsi",
            f"{TIME_START} + cast(({seconds}) AS interval second) + {HALF} AS base_dt",
            "46.95D + cast((event_id*7919 + user_id*104729) % 2600 AS double)/1000 AS lat",
            "-123.8D + cast((event_id*15485863) % 1850 AS double)/1000 AS lon",
            "CASE WHEN event_id % 23 = 0 THEN NULL ELSE cast((event_id*31) % 250 AS double)/10 END AS sog",
            "cast((event_id*37) % 3600 AS double)/10 AS cog",
            "CASE WHEN event_id % 13 = 0 THEN NULL ELSE cast((event_id*41) % 360 AS double) END AS heading",
            "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('IMO', cast(9000000 + user_id AS string)) END AS imo",
            "CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('WD', cast(user_id AS string)) END AS call_sign",
            "CASE WHEN event_id % 3 = 0 THEN NULL ELSE code END AS vessel_type",
            "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS status",
            "CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(10 + (user_id*17) % 300 AS double) END AS l",
            "CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(4 + (user_id*7) % 40 AS double) END AS w",
            "CASE WHEN event_id % 3 = 1 THEN cast((event_id*3) % 150 AS double)/10 END AS draft",
            "CASE WHEN event_id % 6 = 0 THEN NULL ELSE code END AS cargo",
        )
    )


def ais(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without names: a scan of ``events`` and nothing else."""
    return messages_from(table(spark, sf_dir, "events")).drop("user_id")


def ais_with_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All message columns; names come from ``customer``."""
    names = table(spark, sf_dir, "customer").selectExpr("c_custkey AS user_id", "c_name")
    return (
        messages_from(table(spark, sf_dir, "events"))
        .join(names, "user_id", "left")
        .withColumn("vessel_name", F.when(F.col("seq") % 4 != 0, F.col("c_name")))
        .drop("user_id", "c_name")
    )


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feature_id, objl, ring): a closed triangle per part."""
    codes = ", ".join(f"'{c}'" for c in OBJECT_CODES)
    return (
        table(spark, sf_dir, "part")
        .selectExpr(
            "cast(p_partkey AS int) AS feature_id",
            f"get(array({codes}), cast(p_partkey % 5 AS int)) AS objl",
            "-123.9D + cast((p_partkey*7919) % 2000 AS double)/1000 AS x",
            "46.9D + cast((p_partkey*104729) % 2700 AS double)/1000 AS y",
        )
        .selectExpr(
            "feature_id",
            "objl",
            "array(named_struct('lon', x, 'lat', y), named_struct('lon', x + 0.125D, 'lat', y), "
            "named_struct('lon', x + 0.125D, 'lat', y + 0.25D), named_struct('lon', x, 'lat', y)) AS ring",
        )
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box and an interval for each supplier: minutes and harbours for most, hours and coasts for some."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey AS int) AS probe_id",
        f"{TIME_START} + cast((s_suppkey*977) % 14400 AS interval second) AS start",
        f"{TIME_START} + cast((s_suppkey*977) % 14400 + CASE WHEN s_suppkey % 10 = 0 THEN 9000 ELSE 60 + (s_suppkey*37) % 900 END "
        "AS interval second) AS end",
        "46.9D + cast((s_suppkey*7919) % 2500 AS double)/1000 AS lat_min",
        "46.9D + cast((s_suppkey*7919) % 2500 AS double)/1000 + CASE WHEN s_suppkey % 7 = 0 THEN 0.8D ELSE 0.125D END AS lat_max",
        "-123.9D + cast((s_suppkey*104729) % 1900 AS double)/1000 AS lon_min",
        "-123.9D + cast((s_suppkey*104729) % 1900 AS double)/1000 + CASE WHEN s_suppkey % 7 = 0 THEN 0.8D ELSE 0.125D END AS lon_max",
    )


# --- the same, as DuckDB SQL ----------------------------------------------------------

_CODES = ", ".join(f"({i}, {'CAST(NULL AS INT)' if c is None else c})" for i, c in enumerate(TYPE_CODES))

AIS_SQL = f"""ais AS (
 SELECT e.event_id AS seq,
  CAST(366000000 + e.user_id AS INT) AS mmsi,
  make_timestamp((1509861600 + CAST(floor((epoch_us(e.ts) - 1704067200000000)/180000000) AS BIGINT))*1000000
  + CASE WHEN e.event_id % 4 = 1 THEN 500000 ELSE 0 END) AS base_dt,
  46.95e0 + CAST((e.event_id*7919 + e.user_id*104729) % 2600 AS DOUBLE)/1000 AS lat,
  -123.8e0 + CAST((e.event_id*15485863) % 1850 AS DOUBLE)/1000 AS lon,
  CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE CAST((e.event_id*31) % 250 AS DOUBLE)/10 END AS sog,
  CAST((e.event_id*37) % 3600 AS DOUBLE)/10 AS cog,
  CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE CAST((e.event_id*41) % 360 AS DOUBLE) END AS heading,
  CASE WHEN e.event_id % 4 = 0 THEN NULL ELSE c.c_name END AS vessel_name,
  CASE WHEN e.event_id % 5 = 0 THEN NULL ELSE concat('IMO', CAST(9000000 + e.user_id AS VARCHAR)) END AS imo,
  CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE concat('WD', CAST(e.user_id AS VARCHAR)) END AS call_sign,
  CASE WHEN e.event_id % 3 = 0 THEN NULL ELSE vt.code END AS vessel_type,
  CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE e.event_type END AS status,
  CASE WHEN e.event_id % 3 = 0 THEN NULL ELSE CAST(10 + (e.user_id*17) % 300 AS DOUBLE) END AS l,
  CASE WHEN e.event_id % 3 = 0 THEN NULL ELSE CAST(4 + (e.user_id*7) % 40 AS DOUBLE) END AS w,
  CASE WHEN e.event_id % 3 = 1 THEN CAST((e.event_id*3) % 150 AS DOUBLE)/10 END AS draft,
  CASE WHEN e.event_id % 6 = 0 THEN NULL ELSE vt.code END AS cargo
 FROM events e
 JOIN (VALUES {_CODES}) AS vt(idx, code) ON e.user_id % 21 = vt.idx
 LEFT JOIN customer c ON c.c_custkey = e.user_id)"""

MOTION_SQL = f"""motion AS (
 SELECT mmsi, status, base_dt, lat, lon, sog, cog, heading, seq FROM ais
 WHERE lat BETWEEN {LAT_MIN} AND {LAT_MAX} AND lon BETWEEN {LON_MIN} AND {LON_MAX})"""

CALENDAR_SQL = """cal AS (
 SELECT *, CAST(year(localtime_) AS INT) AS year, CAST(month(localtime_) AS INT) AS month,
  CAST(day(localtime_) AS INT) AS day, CAST(dayofweek(localtime_) + 1 AS INT) AS dow
 FROM (SELECT *, (base_dt AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS localtime_ FROM motion))"""

POLYGON_SQL = """lane_polygons AS (
 SELECT feature_id, objl, unnest([0, 1, 2, 3]) AS vtx,
  unnest([x, x + 0.125e0, x + 0.125e0, x]) AS lon, unnest([y, y, y + 0.25e0, y]) AS lat
 FROM (SELECT CAST(p_partkey AS INT) AS feature_id,
   CASE p_partkey % 5 WHEN 0 THEN '96' WHEN 1 THEN '150' WHEN 2 THEN '148' WHEN 3 THEN '152' ELSE '30' END AS objl,
   -123.9e0 + CAST((p_partkey*7919) % 2000 AS DOUBLE)/1000 AS x,
   46.9e0 + CAST((p_partkey*104729) % 2700 AS DOUBLE)/1000 AS y FROM part))"""


PROBE_SQL = """probes AS (
 SELECT CAST(s_suppkey AS INT) AS probe_id, t AS start_dt,
  t + to_seconds(CASE WHEN s_suppkey % 10 = 0 THEN 9000 ELSE 60 + (s_suppkey*37) % 900 END) AS end_dt,
  y AS lat_min, y + CASE WHEN s_suppkey % 7 = 0 THEN 0.8e0 ELSE 0.125e0 END AS lat_max,
  x AS lon_min, x + CASE WHEN s_suppkey % 7 = 0 THEN 0.8e0 ELSE 0.125e0 END AS lon_max
 FROM (SELECT s_suppkey, TIMESTAMP '2017-11-05 06:00:00' + to_seconds((s_suppkey*977) % 14400) AS t,
   46.9e0 + CAST((s_suppkey*7919) % 2500 AS DOUBLE)/1000 AS y, -123.9e0 + CAST((s_suppkey*104729) % 1900 AS DOUBLE)/1000 AS x FROM supplier))"""
