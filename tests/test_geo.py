from math import asin, atan, atan2, cos, degrees, pi, radians, sin, sqrt, tan

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import positions
from wakeline.functions.geofn import geohash_score, geohash_text, haversine, with_destination
from wakeline.operators.geosets import (
    ALL,
    MOVING,
    STATIONARY,
    by_score,
    forecast,
    geo_sets,
    latest_positions,
    members,
    nth_member,
    pair_distance,
    proximity_pairs,
    within,
    within_radius,
    within_radius_of_point,
)
from wakeline.schema import EARTH_RADIUS_MILES

R = EARTH_RADIUS_MILES


def great_circle(lat1, lon1, lat2, lon2):
    p, q = np.radians(lat1), np.radians(lat2)
    h = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * R * np.arcsin(np.sqrt(np.minimum(1, h)))


def scattered(seed, n):
    """Positions everywhere, thick around the poles, the 180th meridian and one harbour."""
    rng = np.random.default_rng(seed)
    lat = np.concatenate([
        rng.uniform(-90, 90, n), rng.uniform(89.9, 90, n), rng.uniform(-90, -89.9, n),
        rng.uniform(-1, 1, n), rng.normal(48, 0.03, n), [90.0, -90.0, 0.0, 0.0],
    ])
    lon = np.concatenate([
        rng.uniform(-180, 180, n), rng.uniform(-180, 180, n), rng.uniform(-180, 180, n),
        rng.choice([-1, 1], n) * rng.uniform(179.8, 180, n), rng.normal(-122.5, 0.03, n), [0.0, 0.0, 180.0, -180.0],
    ])
    return lat, lon


def slot_frame(spark, lat, lon, slots=1):
    data = [(i % slots, i, float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))]
    return spark.createDataFrame(data, "slot int, mmsi int, lat double, lon double")


@pytest.mark.parametrize("miles, cell_rows", [(3.0, 2000), (3.0, 5), (60.0, 2000), (60.0, 7)])
def test_pairs_equal_brute_force(spark, miles, cell_rows):
    lat, lon = scattered(3, 60)
    found = proximity_pairs(slot_frame(spark, lat, lon, slots=2), miles, cell_rows=cell_rows).collect()
    want = {
        (i, j)
        for i in range(len(lat))
        for j in range(i + 1, len(lat))
        if i % 2 == j % 2 and great_circle(lat[i], lon[i], lat[j], lon[j]) <= miles
    }
    assert len(found) == len(want) > 50
    assert {(r.mmsi_a, r.mmsi_b) for r in found} == want


def test_radius_equals_brute_force(spark):
    lat, lon = scattered(4, 40)
    frame = slot_frame(spark, lat, lon).drop("slot")
    for centre in (0, 45, 125, 165, len(lat) - 1, len(lat) - 4):
        found = within_radius(frame, frame.where(f"mmsi = {centre}"), 25.0).collect()
        away = great_circle(lat[centre], lon[centre], lat, lon)
        assert {r.mmsi for r in found} == set(np.flatnonzero(away <= 25.0).tolist())
        assert [r.miles for r in found if r.mmsi == centre] == [0.0]
        near = within_radius_of_point(frame, float(lat[centre]), float(lon[centre]), 25.0).collect()
        assert {r.mmsi for r in near} == {r.mmsi for r in found}


def test_many_centres_in_one_join(spark):
    lat, lon = scattered(6, 30)
    frame = slot_frame(spark, lat, lon).drop("slot")
    found = within_radius(frame, frame, 10.0).collect()
    want = {(i, j) for i in range(len(lat)) for j in range(len(lat)) if great_circle(lat[i], lon[i], lat[j], lon[j]) <= 10}
    assert {(r.centre_mmsi, r.mmsi) for r in found} == want


def test_pair_distance_of_a_missing_member_is_null(spark):
    frame = positions(spark, [(1, 48.0, -122.5, 5.0), (2, 48.1, -122.5, 5.0)])
    assert pair_distance(frame, 1, 2).first().miles == pytest.approx(0.1 * pi / 180 * R)
    assert pair_distance(frame, 1, 9).first().miles is None


def test_sets_pick_the_set_before_the_latest_row(spark, rows):
    frame = positions(spark, [(1, 48.0, -122.0, 5.0), (1, 48.1, -122.0, 3.0), (2, 48.2, -122.0, None)])
    sets = geo_sets(frame)
    assert rows(members(sets, MOVING), "mmsi", "lat") == [(1, 48.0)]
    assert rows(members(sets, STATIONARY), "mmsi", "lat") == [(1, 48.1)]
    assert rows(members(sets, ALL), "mmsi", "lat") == [(1, 48.1), (2, 48.2)]


def test_last_message_wins(spark, rows):
    frame = positions(spark, [(1, 48.0, -122.0, 5.0), (1, 48.3, -122.0, 5.0), (1, None, None, 5.0)])
    assert rows(latest_positions(frame.repartition(3)), "mmsi", "lat") == [(1, 48.3)]


def test_geohash(spark):
    frame = spark.createDataFrame([(57.64911, 10.40744), (-25.382708, -49.265506), (None, 1.0)], "lat double, lon double")
    texts = [r.t for r in frame.select(geohash_text(F.col("lat"), F.col("lon")).alias("t")).collect()]
    assert texts == ["u4pruydqqv", "6gkzwgjzn8", None]


def test_geohash_score_equals_a_bit_loop(spark):
    lat, lon = scattered(8, 50)
    lat = np.clip(lat, -85.05, 85.05)
    frame = slot_frame(spark, lat, lon)
    scores = {r.mmsi: r.s for r in frame.select("mmsi", geohash_score(F.col("lat"), F.col("lon")).alias("s")).collect()}
    for i, (a, b) in enumerate(zip(lat, lon)):
        y = min(int((a + 85.05112878) / (2 * 85.05112878) * 2**26), 2**26 - 1)
        x = min(int((b + 180) / 360 * 2**26), 2**26 - 1)
        want = sum(((y >> k & 1) << 2 * k) | ((x >> k & 1) << 2 * k + 1) for k in range(26))
        assert scores[i] == want


def test_members_come_in_geohash_order(spark):
    frame = positions(spark, [(m, 47.0 + (m * 7 % 10) / 5, -123.0 + (m * 3 % 10) / 9, 5.0) for m in range(10)])
    ordered = by_score(frame).collect()
    assert [r.score for r in ordered] == sorted(r.score for r in ordered)
    assert nth_member(frame, 3).first().mmsi == ordered[3].mmsi
    assert nth_member(frame, 10).collect() == []


def vincenty(lat, lon, bearing, metres):
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    az = radians(bearing)
    u1 = atan((1 - f) * tan(radians(lat)))
    s1 = atan2(tan(u1), cos(az))
    sin_a = cos(u1) * sin(az)
    c2 = 1 - sin_a**2
    u2 = c2 * (a * a - b * b) / (b * b)
    big_a = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    big_b = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    s = metres / (b * big_a)
    for _ in range(40):
        m = cos(2 * s1 + s)
        d = big_b * sin(s) * (m + big_b / 4 * (cos(s) * (2 * m * m - 1) - big_b / 6 * m * (4 * sin(s) ** 2 - 3) * (4 * m * m - 3)))
        s = metres / (b * big_a) + d
    m = cos(2 * s1 + s)
    rest = sin(u1) * sin(s) - cos(u1) * cos(s) * cos(az)
    lat2 = atan2(sin(u1) * cos(s) + cos(u1) * sin(s) * cos(az), (1 - f) * sqrt(sin_a**2 + rest**2))
    lam = atan2(sin(s) * sin(az), cos(u1) * cos(s) - sin(u1) * sin(s) * cos(az))
    c = f / 16 * c2 * (4 + f * (4 - 3 * c2))
    shift = lam - (1 - c) * f * sin_a * (s + c * sin(s) * (m + c * cos(s) * (2 * m * m - 1)))
    return degrees(lat2), (lon + degrees(shift) + 540) % 360 - 180


def _routes(spark):
    rng = np.random.default_rng(2)
    data = [
        (i, float(rng.uniform(-80, 80)), float(rng.uniform(-180, 180)), float(rng.uniform(0, 360)), float(rng.choice([0.0, 2.0, 300.0, 5000.0])))
        for i in range(200)
    ]
    return data, spark.createDataFrame(data, "id int, lat double, lon double, cog double, far double")


def test_ellipsoid_destination(spark):
    data, frame = _routes(spark)
    found = {r.id: r for r in with_destination(frame, F.col("far")).collect()}
    for i, lat, lon, cog, far in data:
        lat2, lon2 = vincenty(lat, lon, cog, far * 1609.344)
        assert found[i].dest_lat == pytest.approx(lat2, abs=1e-8)
        assert (found[i].dest_lon - lon2 + 180) % 360 - 180 == pytest.approx(0, abs=1e-8)


def test_sphere_destination_is_that_far_away(spark):
    _, frame = _routes(spark)
    there = with_destination(frame, F.col("far"), model="sphere")
    gone = haversine(F.col("lat"), F.col("lon"), F.col("dest_lat"), F.col("dest_lon"))
    assert there.select(F.max(F.abs(gone - F.col("far"))).alias("d")).first().d < 1e-6


def test_standing_still_forecasts_the_same_place(spark):
    there = forecast(positions(spark, [(1, 48.0, -122.5, 0.0)])).first()
    assert (there.dest_lat, there.dest_lon) == pytest.approx((48.0, -122.5), abs=1e-12)


def test_missing_course_has_no_destination(spark):
    frame = spark.createDataFrame([(1, 48.0, -122.5, 5.0, None)], "mmsi int, lat double, lon double, sog double, cog double")
    there = forecast(frame).first()
    assert (there.mmsi, there.dest_lat, there.dest_lon) == (1, None, None)


def test_filter_on_a_destination_stays_small(spark):
    there = forecast(positions(spark, [(1, 48.0, -122.5, 10.0), (2, 10.0, -122.5, 10.0)])).where("dest_lat > 20 AND mmsi < 5")
    assert [r.mmsi for r in there.collect()] == [1]


def test_arc_of_a_known_distance():
    assert asin(1.0) * R == pytest.approx(pi / 2 * R)


def test_units(spark):
    rows_ = positions(spark, [(1, 48.0, -122.5, 5.0), (2, 48.02, -122.5, 5.0), (3, 49.0, -122.5, 5.0)])
    miles = pair_distance(rows_, 1, 2).first().miles
    assert pair_distance(rows_, 1, 2, "km").first().kilometres == pytest.approx(miles * 1.609344)
    assert pair_distance(rows_, 1, 2, "ft").first().feet == pytest.approx(miles * 5280)
    centre = rows_.where("mmsi = 1")
    assert {r.mmsi: round(r.metres) for r in within(rows_, centre, 2300, "m").collect()} == {1: 0, 2: round(miles * 1609.344)}
    assert within(rows_, centre, 2200, "m").count() == 1


def test_crowded_cells_do_not_change_a_search(spark, rows):
    rng = np.random.default_rng(8)
    spread = [(i, 48 + float(a) / 50, -122.5 + float(b) / 50, 5.0) for i, (a, b) in enumerate(rng.random((300, 2)))]
    frame = positions(spark, spread)
    centres = frame.where("mmsi < 40")
    want = rows(within_radius(frame, centres, 0.3), "centre_mmsi", "mmsi")
    assert len(want) > 40 and rows(within_radius(frame, centres, 0.3, cell_rows=10), "centre_mmsi", "mmsi") == want
