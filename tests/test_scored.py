import random

import pytest
from pyspark.sql import functions as F

from wakeline.functions.geofn import geohash_score
from wakeline.operators.geosets import within_radius_of_point
from wakeline.operators.scored import AXIS_BITS, score_ranges, within_radius_by_score, write_by_score


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(6000)]
    rows += [(10_000 + i, 48 + rng.gauss(0, 0.2), -122.75 + rng.gauss(0, 0.3)) for i in range(6000)]
    rows += [(20_000, 90.0, 0.0), (20_001, -90.0, 77.0), (20_002, 0.0, 180.0), (20_003, 0.0, -180.0), (20_004, None, 1.0), (20_005, 85.06, 3.0), (20_006, 48.0, -122.75)]
    path = str(tmp_path_factory.mktemp("scored") / "t")
    df = spark.createDataFrame(rows, "mmsi int, lat double, lon double")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")  # several files for a small table
    try:
        write_by_score(df.repartition(8), path)
    finally:
        spark.conf.set(coalesce, before)
    return spark.read.parquet(path), df


PLACES = [
    (48.0, -122.75, 3.0), (48.0, -122.75, 12.0), (48.0, -122.75, 0.0), (0.0, 180.0, 300.0), (0.0, -179.9, 200.0), (89.0, 10.0, 200.0), (-89.9, 10.0, 500.0),
    (85.0, 3.0, 60.0), (10.0, 20.0, 3000.0), (10.0, 20.0, 13000.0), (-60.0, 100.0, 700.0),
]


@pytest.mark.parametrize("lat, lon, miles", PLACES)
def test_ranges_lose_no_position(stored, rows, lat, lon, miles):
    table, df = stored
    found = within_radius_by_score(table, lat, lon, miles)
    assert rows(found, "mmsi", F.round("miles", 6)) == rows(within_radius_of_point(df, lat, lon, miles), "mmsi", F.round("miles", 6))


def test_ranges_are_few_disjoint_and_small():
    for lat, lon, miles in PLACES:
        ranges = score_ranges(lat, lon, miles)
        assert all(a <= b < c for (a, b), (c, _) in zip(ranges, ranges[1:])) and 0 <= ranges[0][0] and ranges[-1][1] < 1 << 2 * AXIS_BITS
    some = score_ranges(48.0, -122.75, 3.0)
    assert len(some) <= 49 and sum(b - a + 1 for a, b in some) < (1 << 2 * AXIS_BITS) // 1_000_000


def test_scores_fall_into_their_ranges(spark):
    points = [(y, x) for y in (-85.0, -12.5, 0.0, 47.99, 84.9) for x in (-180.0, -122.75, -0.01, 0.0, 179.99)]
    df = spark.createDataFrame(points, "lat double, lon double").withColumn("score", geohash_score(F.col("lat"), F.col("lon")))
    for r in df.collect():
        assert any(a <= r.score <= b for a, b in score_ranges(r.lat, r.lon, 1.0))


def test_fewer_files_hold_the_ranges(stored):
    table, _ = stored
    near = within_radius_by_score(table, 10.0, 20.0, 300.0)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(score" in plan
    some = score_ranges(10.0, 20.0, 300.0)
    by_file = table.groupBy(F.input_file_name().alias("f")).agg(F.min("score").alias("a"), F.max("score").alias("z")).collect()
    hit = [r for r in by_file if r.a is not None and any(r.a <= high and low <= r.z for low, high in some)]
    assert len(by_file) >= 4 and len(hit) <= len(by_file) / 2
