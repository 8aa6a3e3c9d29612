"""Registered queries on positions: sets, distances, radius, pairs, forecasts, polygons, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from wakeline.functions.geofn import (
    geohash_text,
    haversine,
    horizon_miles,
    knots_to_mph,
    with_destination,
)
from wakeline.functions.timefn import slot_end
from wakeline.operators.geosets import (
    ALL,
    MOVING,
    by_score,
    first_members,
    forecast,
    forecast_lines,
    forecast_moving,
    geo_sets,
    latest_positions,
    lookup,
    marker_rectangles,
    members,
    nth_member,
    pair_distance,
    proximity_pairs,
    with_score,
    within_radius,
    within_radius_of_point,
)
from wakeline.operators.motion import with_localtime
from wakeline.operators.polygons import lat_lon_rings, ring_points, with_polygon_class
from wakeline.operators.scored import within_radius_by_score, write_by_score
from wakeline.operators.zones import in_polygons
from wakeline.plans.message_queries import minute_rows, motion
from wakeline.plans.registry import (
    SCORED_SQL,
    SLOT_SQL,
    haversine_sql,
    on_ais,
    on_motion,
    on_polygons,
    on_sets,
    register,
    score_sql,
)
from wakeline.plans.testbed import POLYGON_SQL, ais, messages_from, polygons
from wakeline.sources.layers import read_polygons, write_polygons
from wakeline.sources.scratch import materialise, scratch_path
from wakeline.streaming.live import last_hour_activity, latest_by_slot, replay, run_to_end
from wakeline.streaming.retained import retained_points, retained_track, run_retained

LAT0, LON0, WIDE = 48.0, -122.75, 30.0


def sets(spark, sf_dir):
    return geo_sets(minute_rows(spark, sf_dir), keep=("sog", "cog"))


def moving(spark, sf_dir):
    return members(sets(spark, sf_dir), MOVING)


def _round(df, places=4, *columns):
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- sets and lookups -----------------------------------------------------------------


@register("a9_latest_positions", on_sets("SELECT mmsi, lat, lon FROM sets WHERE set_name = 'all'"))
def a9(spark, sf_dir):
    return latest_positions(minute_rows(spark, sf_dir)).select("mmsi", "lat", "lon")


@register("a9_latest_per_slot", on_motion("SELECT slot, mmsi, lat, lon FROM slots", SLOT_SQL))
def a9_slots(spark, sf_dir):
    return slot_positions(spark, sf_dir)


def slot_positions(spark, sf_dir):
    rows = motion(spark, sf_dir).withColumn("slot", slot_end(F.col("base_dt"), 60))
    return latest_positions(rows, ("slot",)).select("slot", "mmsi", "lat", "lon")


@register("u1_named_sets", on_sets("SELECT set_name, mmsi, lat, lon FROM sets"))
def u1(spark, sf_dir):
    return sets(spark, sf_dir).select("set_name", "mmsi", "lat", "lon")


@register("f8_position_lookup", on_sets("SELECT mmsi, lat, lon FROM sets WHERE set_name = 'all' AND mmsi IN (366000007, 366000012, 366000015, 366000017, 366000031, 366000068, 366000124)"))
def f8(spark, sf_dir):
    everyone = members(sets(spark, sf_dir), ALL)
    return lookup(everyone, [366000007, 366000012, 366000015, 366000017, 366000031, 366000068, 366000124]).select("mmsi", "lat", "lon")


# --- geohash order --------------------------------------------------------------------


@register("f9_geohash_score", on_motion(f"SELECT seq, {score_sql()} AS score FROM motion"))
def f9(spark, sf_dir):
    return with_score(motion(spark, sf_dir)).select("seq", "score")


_HASH = "0123456789bcdefghjkmnpqrstuvwxyz"
_LETTERS = " || ".join(
    f"substr('{_HASH}', CAST(((s >> {52 - 5 * (i + 1)}) & 31) + 1 AS INT), 1)" for i in range(10)
)


@register(
    "f9_geohash_text",
    on_motion(f"SELECT seq, {_LETTERS} AS geohash FROM (SELECT seq, {score_sql(limit='90e0')} AS s FROM motion)"),
)
def f9_text(spark, sf_dir):
    return motion(spark, sf_dir).select("seq", geohash_text(F.col("lat"), F.col("lon")).alias("geohash"))


@register("o3_geohash_order", on_sets("SELECT mmsi, score FROM scored ORDER BY score, mmsi", SCORED_SQL))
def o3(spark, sf_dir):
    return by_score(moving(spark, sf_dir)).select("mmsi", "score")


@register("o4_first_members", on_sets("SELECT mmsi, score FROM scored ORDER BY score, mmsi LIMIT 10", SCORED_SQL))
def o4(spark, sf_dir):
    return first_members(moving(spark, sf_dir)).select("mmsi", "score")


@register("o7_nth_member", on_sets("SELECT mmsi, lat, lon FROM scored ORDER BY score, mmsi LIMIT 1 OFFSET 10", SCORED_SQL))
def o7(spark, sf_dir):
    return nth_member(moving(spark, sf_dir), 10).select("mmsi", "lat", "lon")


# --- distances and radius -------------------------------------------------------------

CENTRE_SQL = "centre AS (SELECT mmsi, lat, lon FROM scored ORDER BY score, mmsi LIMIT 1 OFFSET 10)"


def _radius_sql(name: str, miles: float) -> str:
    away = haversine_sql("c.lat", "c.lon", "s.lat", "s.lon")
    return on_sets(
        f"SELECT c.mmsi AS centre_mmsi, s.mmsi, s.lat, s.lon, round({away}, 4) AS miles FROM sets s, centre c "
        f"WHERE s.set_name = '{name}' AND {away} <= {miles}",
        SCORED_SQL,
        CENTRE_SQL,
    )


def _radius(name: str, miles: float):
    def run(spark, sf_dir):
        found = materialise(sets(spark, sf_dir), "sets")  # for the centre and for the search
        centre = nth_member(members(found, MOVING), 10)
        return _round(within_radius(members(found, name), centre, miles), 4, "miles")

    return run


register("j5_radius_in_moving", _radius_sql("moving", 3))(_radius(MOVING, 3.0))
register("j5_radius_in_all", _radius_sql("all", 3))(_radius(ALL, 3.0))
register("j5_wide_radius_in_all", _radius_sql("all", WIDE))(_radius(ALL, WIDE))

_PAIR = haversine_sql("a.lat", "a.lon", "b.lat", "b.lon")


def _pair(first, second):
    sql = on_sets(
        f"SELECT round({_PAIR}, 4) AS miles FROM (SELECT 1) LEFT JOIN "
        f"(SELECT * FROM sets WHERE set_name = 'all' AND mmsi = {first}) a ON true LEFT JOIN "
        f"(SELECT * FROM sets WHERE set_name = 'all' AND mmsi = {second}) b ON true"
    )

    def run(spark, sf_dir):
        return _round(pair_distance(members(sets(spark, sf_dir), ALL), first, second), 4, "miles")

    return sql, run


for _name, _first, _second in (
    ("j6_pair_distance", 366000015, 366000017),
    ("j6_missing_member", 366000007, 366000012),
):
    _sql, _run = _pair(_first, _second)
    register(_name, _sql)(_run)


@register(
    "f7_distance",
    on_motion(f"SELECT seq, round({haversine_sql('lat', 'lon', '48e0', '-122.75e0')}, 4) AS miles FROM motion"),
)
def f7(spark, sf_dir):
    away = haversine(F.col("lat"), F.col("lon"), F.lit(LAT0), F.lit(LON0))
    return motion(spark, sf_dir).select("seq", F.round(away, 4).alias("miles"))


@register(
    "f10_radius_of_point",
    on_motion(
        f"SELECT seq, mmsi, round({haversine_sql('48e0', '-122.75e0', 'lat', 'lon')}, 4) AS miles FROM motion "
        f"WHERE {haversine_sql('48e0', '-122.75e0', 'lat', 'lon')} <= 12"
    ),
)
def f10(spark, sf_dir):
    near = within_radius_of_point(motion(spark, sf_dir), LAT0, LON0, 12.0)
    return _round(near.select("seq", "mmsi", "miles"), 4, "miles")


@register(
    "f10_radius_by_score",
    on_motion(
        f"SELECT seq, mmsi, round({haversine_sql('48e0', '-122.75e0', 'lat', 'lon')}, 4) AS miles FROM motion "
        f"WHERE {haversine_sql('48e0', '-122.75e0', 'lat', 'lon')} <= 12"
    ),
)
def f10_by_score(spark, sf_dir):
    path = scratch_path(spark, "by-score")
    write_by_score(motion(spark, sf_dir), path)
    near = within_radius_by_score(spark.read.parquet(path), LAT0, LON0, 12.0)
    return _round(near.select("seq", "mmsi", "miles"), 4, "miles")


@register(
    "j9_proximity_pairs",
    on_motion(
        f"SELECT a.slot, a.mmsi AS mmsi_a, b.mmsi AS mmsi_b, round({_PAIR}, 4) AS miles "
        f"FROM slots a JOIN slots b ON a.slot = b.slot AND a.mmsi < b.mmsi WHERE {_PAIR} <= 3",
        SLOT_SQL,
    ),
)
def j9(spark, sf_dir):
    stored = materialise(slot_positions(spark, sf_dir), "slot-positions")
    return _round(proximity_pairs(stored), 4, "miles")


# --- forecasts ------------------------------------------------------------------------

MILES_SQL = "(sog * 5 / 60 * 1.15078e0)"


def _sphere_sql(rows: str, keys: str) -> str:
    return (
        f"SELECT {keys}, round(degrees(phi2), 5) AS dest_lat, round(lon + degrees(atan2(sin(theta) * sin(delta) * cos(phi), "
        "cos(delta) - sin(phi) * sin(phi2))), 5) AS dest_lon FROM (SELECT *, asin(sin(phi) * cos(delta) + "
        "cos(phi) * sin(delta) * cos(theta)) AS phi2 FROM (SELECT *, radians(lat) AS phi, radians(cog) AS theta, "
        f"{MILES_SQL} / 3958.7613e0 AS delta FROM {rows}))"
    )


_F = "(1 / 298.257223563e0)"
_B = f"(6378137e0 * (1 - {_F}))"


def _round_trip(source: str, target: str) -> str:
    return (
        f"{target} AS MATERIALIZED (SELECT * EXCLUDE (sigma), arc + bb * sin(sigma) * (cos(2 * s1 + sigma) + bb / 4 * ("
        "cos(sigma) * (2 * cos(2 * s1 + sigma) ^ 2 - 1) - bb / 6 * cos(2 * s1 + sigma) * (4 * sin(sigma) ^ 2 - 3) "
        f"* (4 * cos(2 * s1 + sigma) ^ 2 - 3))) AS sigma FROM {source})"
    )


def _ellipsoid_tables(rows: str) -> tuple[str, ...]:
    return (
        f"g1 AS MATERIALIZED (SELECT *, sin(radians(cog)) AS sa1, cos(radians(cog)) AS ca1, atan((1 - {_F}) * tan(radians(lat))) AS u "
        f"FROM {rows})",
        "g2 AS MATERIALIZED (SELECT *, atan2(tan(u), ca1) AS s1, cos(u) * sa1 AS sa FROM g1)",
        f"g3 AS MATERIALIZED (SELECT *, 1 - sa ^ 2 AS c2a, (1 - sa ^ 2) * ((6378137e0 ^ 2 - {_B} ^ 2) / {_B} ^ 2) AS uu FROM g2)",
        "g4 AS MATERIALIZED (SELECT *, 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu))) AS aa, "
        "uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu))) AS bb FROM g3)",
        f"g5 AS MATERIALIZED (SELECT *, {MILES_SQL} * 1609.344e0 / ({_B} * aa) AS arc FROM g4)",
        "r0 AS (SELECT *, arc AS sigma FROM g5)",
        _round_trip("r0", "r1"),
        _round_trip("r1", "r2"),
        _round_trip("r2", "r3"),
        _round_trip("r3", "r4"),
        "g6 AS MATERIALIZED (SELECT *, cos(2 * s1 + sigma) AS c2m, sin(u) * sin(sigma) - cos(u) * cos(sigma) * ca1 AS rest, "
        "atan2(sin(sigma) * sa1, cos(u) * cos(sigma) - sin(u) * sin(sigma) * ca1) AS lam, "
        f"{_F} / 16 * c2a * (4 + {_F} * (4 - 3 * c2a)) AS cc FROM r4)",
    )


_ELLIPSOID_ROW = (
    f"round(degrees(atan2(sin(u) * cos(sigma) + cos(u) * sin(sigma) * ca1, (1 - {_F}) * sqrt(sa ^ 2 + rest ^ 2))), 5) "
    f"AS dest_lat, round(lon + degrees(lam - (1 - cc) * {_F} * sa * (sigma + cc * sin(sigma) * (c2m + cc * cos(sigma) "
    "* (2 * c2m ^ 2 - 1)))), 5) AS dest_lon FROM g6"
)


def _destinations(spark, sf_dir, model):
    rows = with_destination(motion(spark, sf_dir), horizon_miles(F.col("sog")), model=model)
    return _round(rows.select("seq", "dest_lat", "dest_lon"), 5, "dest_lat", "dest_lon")


@register("f11_destination_sphere", on_motion(_sphere_sql("motion", "seq")))
def f11_sphere(spark, sf_dir):
    return _destinations(spark, sf_dir, "sphere")


@register("f11_destination_wgs84", on_motion(f"SELECT seq, {_ELLIPSOID_ROW}", *_ellipsoid_tables("motion")))
def f11_wgs84(spark, sf_dir):
    return _destinations(spark, sf_dir, "wgs84")


@register("x2_destination_of_fast_rows", on_motion(f"SELECT mmsi, seq, {_ELLIPSOID_ROW} WHERE sog >= 4", *_ellipsoid_tables("motion")))
def x2(spark, sf_dir):
    rows = forecast(motion(spark, sf_dir).where(F.col("sog") >= 4))
    return _round(rows.select("mmsi", "seq", "dest_lat", "dest_lon"), 5, "dest_lat", "dest_lon")


@register("f12_horizon_miles", on_motion(f"SELECT seq, round({MILES_SQL}, 8) AS miles FROM motion"))
def f12(spark, sf_dir):
    return motion(spark, sf_dir).select("seq", F.round(horizon_miles(F.col("sog")), 8).alias("miles"))


@register("f24_knots_to_mph", on_motion("SELECT seq, round(sog * 1.15078e0, 6) AS mph FROM motion"))
def f24(spark, sf_dir):
    return motion(spark, sf_dir).select("seq", F.round(knots_to_mph(F.col("sog")), 6).alias("mph"))


MOVING_SQL = "movers AS (SELECT * FROM sets WHERE set_name = 'moving')"


@register("t8_forecast_moving", on_sets(f"SELECT mmsi, {_ELLIPSOID_ROW}", MOVING_SQL, *_ellipsoid_tables("movers")))
def t8(spark, sf_dir):
    rows = forecast_moving(minute_rows(spark, sf_dir))
    return _round(rows.select("mmsi", "dest_lat", "dest_lon"), 5, "dest_lat", "dest_lon")


@register("t8_forecast_moving_sphere", on_sets(_sphere_sql("movers", "mmsi"), MOVING_SQL))
def t8_sphere(spark, sf_dir):
    rows = forecast_moving(minute_rows(spark, sf_dir), model="sphere")
    return _round(rows.select("mmsi", "dest_lat", "dest_lon"), 5, "dest_lat", "dest_lon")


@register(
    "j7_forecast_lines",
    on_sets(
        "SELECT mmsi, 0 AS idx, round(lat, 5) AS lat, round(lon, 5) AS lon FROM movers UNION ALL "
        f"SELECT mmsi, 1, dest_lat, dest_lon FROM (SELECT mmsi, {_ELLIPSOID_ROW})",
        MOVING_SQL,
        *_ellipsoid_tables("movers"),
    ),
)
def j7(spark, sf_dir):
    lines = forecast_lines(forecast_moving(minute_rows(spark, sf_dir)))
    rows = lines.select("mmsi", F.posexplode("points").alias("idx", "p")).select("mmsi", "idx", "p.*")
    return _round(rows, 5, "lat", "lon")


@register(
    "p17_marker_rectangles",
    on_sets(
        "SELECT mmsi, round(lat - 0.0010, 5) AS south, round(lon - 0.0015, 5) AS west, "
        "round(lat + 0.0010, 5) AS north, round(lon + 0.0015, 5) AS east FROM sets WHERE set_name = 'moving'"
    ),
)
def p17(spark, sf_dir):
    boxes = marker_rectangles(moving(spark, sf_dir)).select("mmsi", "south", "west", "north", "east")
    return _round(boxes, 5, "south", "west", "north", "east")


# --- polygons -------------------------------------------------------------------------

CLASS_CASE = (
    "CASE WHEN objl = '96' THEN 'precautionary_area' WHEN objl = '150' THEN 'separation_scheme' ELSE 'lane' END "
    "AS polygon_class"
)
KEPT = "WHERE objl IN ('96', '150', '148', '152')"


@register("s9_polygon_scan", on_polygons("SELECT feature_id, objl, vtx, round(lon, 6) AS lon, round(lat, 6) AS lat FROM lane_polygons"))
def s9(spark, sf_dir):
    path = scratch_path(spark, "polygons")
    write_polygons(polygons(spark, sf_dir), path)
    layer = read_polygons(spark, path).withColumn("feature_id", F.col("feature_id").cast("int"))
    return _round(ring_points(layer), 6, "lon", "lat")


@register("p14_polygon_class", on_polygons(f"SELECT DISTINCT feature_id, objl, {CLASS_CASE} FROM lane_polygons {KEPT}"))
def p14(spark, sf_dir):
    return with_polygon_class(polygons(spark, sf_dir)).select("feature_id", "objl", "polygon_class")


@register(
    "p18_exterior_rings",
    on_polygons(
        f"SELECT feature_id, {CLASS_CASE}, vtx, round(lat, 6) AS lat, round(lon, 6) AS lon FROM lane_polygons {KEPT}"
    ),
)
def p18(spark, sf_dir):
    rings = lat_lon_rings(with_polygon_class(polygons(spark, sf_dir))).drop("objl")
    return _round(ring_points(rings), 6, "lat", "lon")


@register(
    "u2_polygon_classes",
    on_polygons(
        f"SELECT polygon_class, count(*) AS n FROM (SELECT DISTINCT feature_id, {CLASS_CASE} FROM lane_polygons {KEPT}) "
        "GROUP BY polygon_class"
    ),
)
def u2_polygons(spark, sf_dir):
    return with_polygon_class(polygons(spark, sf_dir)).groupBy("polygon_class").agg(F.count(F.lit(1)).alias("n"))


# Even and odd crossings of a ray to the east; a position on an edge is inside.
IN_LANE_SQL = """edges AS (
 SELECT a.feature_id, a.objl, a.lat AS y1, a.lon AS x1, b.lat AS y2, b.lon AS x2 FROM lane_polygons a
 JOIN lane_polygons b ON a.feature_id = b.feature_id AND b.vtx = (a.vtx + 1) % 4),
tested AS (
 SELECT p.mmsi, p.lat, p.lon, e.feature_id, any_value(e.objl) AS objl,
  count(*) FILTER (WHERE (y1 > p.lat) <> (y2 > p.lat) AND p.lon < (x2 - x1) * (p.lat - y1) / (y2 - y1) + x1) AS crossed,
  bool_or((x2 - x1) * (p.lat - y1) - (y2 - y1) * (p.lon - x1) = 0
   AND p.lat BETWEEN least(y1, y2) AND greatest(y1, y2) AND p.lon BETWEEN least(x1, x2) AND greatest(x1, x2)) AS touched
 FROM latest p JOIN edges e ON true GROUP BY p.mmsi, p.lat, p.lon, e.feature_id)"""


@register(
    "p18_vessels_in_polygons",
    on_motion(
        f"SELECT mmsi, lat, lon, feature_id, {CLASS_CASE} FROM tested {KEPT} AND (touched OR crossed % 2 = 1)",
        POLYGON_SQL,
        "latest AS (SELECT mmsi, last(lat ORDER BY base_dt, seq) AS lat, last(lon ORDER BY base_dt, seq) AS lon FROM motion GROUP BY mmsi)",
        IN_LANE_SQL,
    ),
)
def p18_in_polygons(spark, sf_dir):
    latest = latest_positions(motion(spark, sf_dir)).select("mmsi", "lat", "lon")
    return in_polygons(latest, with_polygon_class(polygons(spark, sf_dir)))


# --- streams --------------------------------------------------------------------------


def replayed(spark, sf_dir, label):
    """The messages as a stream in order of time, and at rest."""
    return replay(ais(spark, sf_dir), label)


@register(
    "st1_latest_by_slot",
    on_ais(
        "SELECT slot_start, mmsi, last(lat ORDER BY base_dt, seq) AS lat, last(lon ORDER BY base_dt, seq) AS lon FROM "
        "(SELECT *, date_trunc('minute', base_dt) AS slot_start FROM ais) "
        "GROUP BY slot_start, mmsi"
    ),
)
def st1(spark, sf_dir):
    live, still = map(latest_by_slot, replayed(spark, sf_dir, "slots-replay"))
    return run_to_end(live, still, F.col("slot_start") + F.expr("INTERVAL 1 MINUTE"), "latest-by-slot")


@register(
    "st2_last_hour_activity",
    on_ais(
        "SELECT window_end, mmsi, count(*) AS n_points, min(base_dt) AS first_dt, max(base_dt) AS last_dt FROM "
        "(SELECT mmsi, base_dt, unnest(generate_series(1, 60)) AS k FROM ais), "
        "LATERAL (SELECT date_trunc('minute', base_dt) + to_minutes(k) AS window_end) "
        "GROUP BY window_end, mmsi"
    ),
)
def st2(spark, sf_dir):
    live, still = map(last_hour_activity, replayed(spark, sf_dir, "hours-replay"))
    return run_to_end(live, still, F.col("window_end"), "last-hour")


@register(
    "st2_last_hour_track",
    on_ais(
        "SELECT mmsi, CAST(row_number() OVER (PARTITION BY mmsi ORDER BY base_dt, seq) - 1 AS INTEGER) AS idx, base_dt, lat, lon, sog "
        "FROM (SELECT *, max(base_dt) OVER (PARTITION BY mmsi) AS newest FROM ais) WHERE base_dt > newest - INTERVAL 1 HOUR"
    ),
)
def st2_track(spark, sf_dir):
    """The stream keeps each vessel's last hour as state; the tracks are read from that state. Order does not matter."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # The pattern matches this one table; a stream does not take the name of a single file.
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(f"{sf_dir}/events.parque[t]")
    place = scratch_path(spark, "retained")
    run_retained(retained_track(messages_from(events)), place)
    return retained_points(spark, place)


# --- flagship -------------------------------------------------------------------------

FLAGSHIP_SQL = on_motion(
    "SELECT c.mmsi AS centre_mmsi, p.mmsi, p.lat, p.lon, "
    f"round({haversine_sql('c.lat', 'c.lon', 'p.lat', 'p.lon')}, 4) AS miles FROM placed p, "
    "(SELECT * FROM placed ORDER BY mmsi LIMIT 1) c "
    f"WHERE {haversine_sql('c.lat', 'c.lon', 'p.lat', 'p.lon')} <= 3",
    "local_rows AS (SELECT *, make_timestamp(CAST(ceil(epoch_us((base_dt AT TIME ZONE 'UTC') "
    "AT TIME ZONE 'America/Los_Angeles') / 60e6) * 60000000 AS BIGINT)) AS slot FROM motion)",
    "busiest AS (SELECT slot FROM local_rows GROUP BY slot ORDER BY count(*) DESC, slot LIMIT 1)",
    "placed AS (SELECT mmsi, last(lat ORDER BY base_dt, seq) AS lat, last(lon ORDER BY base_dt, seq) AS lon "
    "FROM local_rows WHERE slot = (SELECT slot FROM busiest) GROUP BY mmsi)",
)


@register("flagship_neighbours", FLAGSHIP_SQL)
def flagship(spark, sf_dir):
    """Vessels within 3 miles of the vessel of lowest id in the busiest local minute."""
    rows = with_localtime(motion(spark, sf_dir)).withColumn("slot", slot_end(F.col("localtime"), 60))
    busiest = (
        rows.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "slot").limit(1).select("slot")
    )
    # One minute's positions: stored, as centre and search both read them.
    positions = materialise(latest_positions(rows.join(F.broadcast(busiest), "slot", "left_semi")), "minute")
    centre = positions.orderBy("mmsi").limit(1)
    return _round(within_radius(positions, centre), 4, "miles")
