"""Registered queries on messages: scans, sinks, projections, filters, time, order."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wakeline.functions.timefn import days_in_month, epoch_millis, localtime
from wakeline.operators.motion import (
    attribute_columns,
    clean_speeds,
    in_box,
    in_motion,
    motion_columns,
    moving,
    near_place_and_time,
    random_anchor,
    random_vessels,
    sample_period,
    snapshot,
    sort_by_time,
    stationary,
    with_calendar,
    with_localtime,
)
from wakeline.operators.probes import near_places_and_times
from wakeline.plans.registry import HOUR_SQL, on_ais, on_calendar, on_minute, on_motion, register
from wakeline.plans.testbed import PROBE_SQL, ais, ais_with_names, probes
from wakeline.sources.messages import read_ais_csv, write_ais_csv
from wakeline.sources.scratch import exists, materialise, scratch_path
from wakeline.sources.tables import (
    read_day,
    read_table,
    register_table,
    write_by_day,
    write_by_time,
    write_if_absent,
)

MINUTE_AT = datetime(2017, 11, 5, 0, 0, 30)
HOUR_AT = datetime(2017, 11, 5, 1, 20, 0)

RAW = (
    "mmsi", "base_dt", "lat", "lon", "sog", "cog", "heading", "vessel_name", "imo", "call_sign",
    "vessel_type", "status", "l", "w", "draft", "cargo",
)
MOTION_ROW = "mmsi, status, base_dt, lat, lon, sog, cog, heading, seq"


def motion(spark, sf_dir):
    return in_box(motion_columns(ais(spark, sf_dir)))


def calendar(spark, sf_dir):
    return with_calendar(motion(spark, sf_dir))


_layouts: dict[tuple[str, str], str] = {}


def day_layout(spark, sf_dir):
    """Path of the motion table by local day: laid out once for a session and table, and again if it was released."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _layouts or not exists(spark, _layouts[key]):
        _layouts[key] = _by_day(spark, sf_dir)
    return _layouts[key]


def by_day(spark, sf_dir):
    return read_table(spark, day_layout(spark, sf_dir))


def _snapshot(spark, sf_dir, at, width):
    """Motion columns and local time of a snapshot, from the day folders that it touches."""
    rows = snapshot(by_day(spark, sf_dir), at, width)
    return rows.select(*motion(spark, sf_dir).columns, "localtime")


def minute_rows(spark, sf_dir):
    return _snapshot(spark, sf_dir, MINUTE_AT, timedelta(minutes=1))


def hour_rows(spark, sf_dir):
    return _snapshot(spark, sf_dir, HOUR_AT, timedelta(hours=1))


# --- scans and sinks ------------------------------------------------------------------


@register("s1_csv_scan", on_ais(f"SELECT {', '.join(RAW)} FROM ais"))
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "messages-csv")
    write_ais_csv(ais_with_names(spark, sf_dir).select(*RAW), path)
    rows = clean_speeds(read_ais_csv(spark, path + "/*.csv"))
    return rows.withColumns({c: F.round(F.col(c).cast("double"), 1) for c in ("l", "w", "draft")})


@register(
    "s2_parquet_scan",
    "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY event_type",
)
def parquet_scan(spark, sf_dir):
    return (
        read_table(spark, f"{sf_dir}/events.parquet")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))
    )


def _by_day(spark, sf_dir):
    path = scratch_path(spark, "by-day")
    write_by_day(calendar(spark, sf_dir), path)
    return path


@register(
    "s3_day_partition_read",
    on_calendar(
        "SELECT mmsi, base_dt, localtime_ AS localtime, lat, lon, dow FROM cal "
        "WHERE year = 2017 AND month = 11 AND day = 4"
    ),
)
def day_partition_read(spark, sf_dir):
    day = read_day(spark, day_layout(spark, sf_dir), 2017, 11, 4)
    return day.select("mmsi", "base_dt", "localtime", "lat", "lon", "dow")


@register("s5_write_if_absent", on_motion(f"SELECT {MOTION_ROW} FROM motion"))
def write_twice(spark, sf_dir):
    path = scratch_path(spark, "motion")
    rows = motion(spark, sf_dir)
    write_if_absent(rows, path)
    write_if_absent(stationary(rows), path)
    return read_table(spark, path)


@register(
    "s6_write_by_day",
    on_calendar("SELECT year, month, day, count(*) AS n, min(localtime_) AS first_local FROM cal GROUP BY ALL"),
)
def write_days(spark, sf_dir):
    return (
        read_table(spark, _by_day(spark, sf_dir))
        .groupBy("year", "month", "day")
        .agg(F.count(F.lit(1)).alias("n"), F.min("localtime").alias("first_local"))
    )


@register(
    "s10_register_table",
    on_calendar("SELECT day, dow, count(*) AS n, count(sog) AS n_sog FROM cal GROUP BY day, dow"),
)
def catalog_table(spark, sf_dir):
    path = day_layout(spark, sf_dir)
    name = "by_day_" + path.rsplit("-", 1)[1]
    return (
        register_table(spark, name, path)
        .groupBy("day", "dow")
        .agg(F.count(F.lit(1)).alias("n"), F.count("sog").alias("n_sog"))
    )


@register(
    "s12_materialise_once",
    on_motion(
        "SELECT 'status' AS kind, status AS value, count(*) AS n FROM motion GROUP BY status "
        "UNION ALL SELECT 'vessel', CAST(mmsi AS VARCHAR), count(*) FROM motion GROUP BY mmsi"
    ),
)
def materialise_once(spark, sf_dir):
    stored = materialise(motion(spark, sf_dir), "motion")

    def counts(kind, column):
        return (
            stored.groupBy(F.col(column).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(kind).alias("kind"), "value", "n")
        )

    return counts("status", "status").unionByName(counts("vessel", "mmsi"))


# --- projections and filters ----------------------------------------------------------


@register("p1_motion_columns", on_ais(f"SELECT {MOTION_ROW} FROM ais"))
def p1(spark, sf_dir):
    return motion_columns(ais(spark, sf_dir))


@register(
    "p2_attribute_columns",
    on_ais("SELECT mmsi, vessel_type, vessel_name, imo, call_sign, l, w, draft, cargo FROM ais"),
)
def p2(spark, sf_dir):
    return attribute_columns(ais_with_names(spark, sf_dir))


@register("p3_bounding_box", on_motion(f"SELECT {MOTION_ROW} FROM motion"))
def p3(spark, sf_dir):
    return motion(spark, sf_dir)


SNAPSHOT_ROW = "mmsi, base_dt, localtime_ AS localtime, lat, lon, sog, cog, seq"


@register("p4_minute_snapshot", on_minute(f"SELECT {SNAPSHOT_ROW} FROM minute_rows"))
def p4(spark, sf_dir):
    rows = snapshot(by_day(spark, sf_dir), MINUTE_AT)
    return rows.select("mmsi", "base_dt", "localtime", "lat", "lon", "sog", "cog", "seq")


@register("p5_hour_snapshot", on_calendar(f"SELECT {SNAPSHOT_ROW} FROM hour_rows", HOUR_SQL))
def p5(spark, sf_dir):
    rows = snapshot(by_day(spark, sf_dir), HOUR_AT, timedelta(hours=1))
    return rows.select("mmsi", "base_dt", "localtime", "lat", "lon", "sog", "cog", "seq")


@register(
    "p6_moving_stationary",
    on_motion(
        "SELECT 'moving' AS kind, mmsi, sog, seq FROM motion WHERE sog >= 4 "
        "UNION ALL SELECT 'stationary', mmsi, sog, seq FROM motion WHERE sog < 4"
    ),
)
def p6(spark, sf_dir):
    rows = motion(spark, sf_dir).select("mmsi", "sog", "seq")
    return (
        moving(rows).withColumn("kind", F.lit("moving"))
        .unionByName(stationary(rows).withColumn("kind", F.lit("stationary")))
    )


@register("p7_in_motion_points", on_motion("SELECT mmsi, base_dt, sog, seq FROM motion WHERE sog >= 1"))
def p7(spark, sf_dir):
    return in_motion(motion(spark, sf_dir)).select("mmsi", "base_dt", "sog", "seq")


@register(
    "p10_sample_period",
    on_calendar(
        "SELECT mmsi, localtime_ AS localtime, lat, lon FROM cal "
        "WHERE localtime_ >= TIMESTAMP '2017-11-05 00:00:00' AND localtime_ < TIMESTAMP '2018-01-01'"
    ),
)
def p10(spark, sf_dir):
    rows = sample_period(calendar(spark, sf_dir), "2017-11-05 00:00:00", "2018-01-01 00:00:00")
    return rows.select("mmsi", "localtime", "lat", "lon")


@register(
    "p12_near_place_and_time",
    on_calendar(
        "SELECT mmsi, base_dt, lat, lon, day FROM cal "
        "WHERE base_dt BETWEEN TIMESTAMP '2017-11-05 06:30:00' AND TIMESTAMP '2017-11-05 07:30:00' "
        "AND lat BETWEEN 47.5 AND 48.5 AND lon BETWEEN -123.25 AND -122.25"
    ),
)
def p12(spark, sf_dir):
    rows = near_place_and_time(
        by_day(spark, sf_dir),
        datetime(2017, 11, 5, 6, 30),
        datetime(2017, 11, 5, 7, 30),
        47.5, 48.5, -123.25, -122.25,
    )
    return rows.select("mmsi", "base_dt", "lat", "lon", "day")


@register(
    "p12_near_places_and_times",
    on_calendar(
        "SELECT probe_id, mmsi, seq, base_dt, lat, lon FROM cal JOIN probes ON base_dt BETWEEN start_dt AND end_dt "
        "AND lat BETWEEN lat_min AND lat_max AND lon BETWEEN lon_min AND lon_max",
        PROBE_SQL,
    ),
)
def p12_probes(spark, sf_dir):
    days = by_day(spark, sf_dir)
    return near_places_and_times(days, probes(spark, sf_dir), keep=("seq",))


@register(
    "p19_calendar_columns",
    on_calendar("SELECT mmsi, seq, base_dt, localtime_ AS localtime, year, month, day, dow FROM cal"),
)
def p19(spark, sf_dir):
    return calendar(spark, sf_dir).select("mmsi", "seq", "base_dt", "localtime", "year", "month", "day", "dow")


# --- time functions -------------------------------------------------------------------


@register(
    "f1_localtime",
    on_ais("SELECT seq, (base_dt AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS localtime FROM ais"),
)
def f1(spark, sf_dir):
    return ais(spark, sf_dir).select("seq", localtime(F.col("base_dt")).alias("localtime"))


def _count_by(column):
    def run(spark, sf_dir):
        return calendar(spark, sf_dir).groupBy(column).agg(F.count(F.lit(1)).alias("n"))

    return run


for _name, _column in (("f2_year", "year"), ("f3_month", "month"), ("f4_day", "day"), ("f5_day_of_week", "dow")):
    register(_name, on_calendar(f"SELECT {_column}, count(*) AS n FROM cal GROUP BY {_column}"))(_count_by(_column))


@register(
    "f6_epoch_millis",
    on_calendar("SELECT seq, CAST(epoch_us(localtime_) // 1000000 * 1000 AS BIGINT) AS ts_ms_local FROM cal"),
)
def f6(spark, sf_dir):
    return calendar(spark, sf_dir).select("seq", epoch_millis(F.col("localtime")).alias("ts_ms_local"))


@register(
    "f22_days_in_month",
    on_calendar(
        "SELECT year, month, CAST(day(last_day(localtime_)) AS INT) AS days, count(*) AS n FROM cal GROUP BY ALL"
    ),
)
def f22(spark, sf_dir):
    return (
        calendar(spark, sf_dir)
        .groupBy("year", "month", days_in_month(F.col("localtime").cast("date")).alias("days"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- order and sample -----------------------------------------------------------------


@register("o1_sort_by_time", on_motion(f"SELECT {MOTION_ROW} FROM motion ORDER BY base_dt, seq"))
def o1(spark, sf_dir):
    return sort_by_time(motion(spark, sf_dir))


@register(
    "o1_write_by_time",
    on_motion("SELECT status, count(*) AS n, min(base_dt) AS first_dt, max(base_dt) AS last_dt FROM motion GROUP BY status"),
)
def o1_write(spark, sf_dir):
    path = scratch_path(spark, "motion-by-time")
    write_by_time(motion(spark, sf_dir), path)
    return (
        read_table(spark, path)
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("base_dt").alias("first_dt"), F.max("base_dt").alias("last_dt")
        )
    )


@register(
    "o6_random_vessels",
    on_motion(
        "SELECT mmsi FROM (SELECT DISTINCT mmsi FROM motion) "
        "ORDER BY md5(concat(CAST(mmsi AS VARCHAR), ':7')), mmsi LIMIT 10"
    ),
)
def o6(spark, sf_dir):
    return random_vessels(motion(spark, sf_dir), seed=7)


@register(
    "o8_random_anchor",
    on_calendar(
        "SELECT localtime_ AS localtime FROM (SELECT DISTINCT localtime_ FROM cal) "
        "ORDER BY md5(concat(CAST(localtime_ AS VARCHAR), ':7')), localtime_ LIMIT 1"
    ),
)
def o8(spark, sf_dir):
    return random_anchor(with_localtime(motion(spark, sf_dir)), seed=7)
