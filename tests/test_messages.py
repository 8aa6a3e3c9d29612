from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.frames import SCHEMA, START
from wakeline.functions.timefn import epoch_millis, localtime, ntz, slot_end
from wakeline.operators.motion import (
    clean_speeds,
    in_box,
    in_motion,
    moving,
    near_place_and_time,
    random_vessels,
    sample_period,
    snapshot,
    stationary,
    with_calendar,
    with_localtime,
)


def test_box_is_inclusive_and_drops_missing_positions(spark, rows):
    points = [(47.0, -123.0), (49.45, -123.0), (46.999, -123.0), (49.451, -123.0), (48.0, -123.75),
              (48.0, -122.0), (48.0, -123.751), (48.0, -121.999), (None, -123.0), (48.0, None)]
    df = spark.createDataFrame(points, "lat double, lon double")
    assert len(rows(in_box(df))) == 4


def _utc(spark, *times):
    return spark.createDataFrame([(i, t) for i, t in enumerate(times)], "seq int, base_dt timestamp_ntz")


def test_localtime_across_the_clock_change(spark, rows):
    df = _utc(spark, datetime(2017, 11, 5, 8, 30), datetime(2017, 11, 5, 9, 30), datetime(2017, 3, 12, 9, 59, 59),
              datetime(2017, 3, 12, 10, 0, 0))
    local = rows(df.select("seq", localtime(F.col("base_dt")).alias("t")))
    assert [t for _, t in local] == [
        datetime(2017, 11, 5, 1, 30), datetime(2017, 11, 5, 1, 30),
        datetime(2017, 3, 12, 1, 59, 59), datetime(2017, 3, 12, 3, 0, 0),
    ]


def test_calendar_columns(spark):
    row = with_calendar(_utc(spark, datetime(2017, 11, 5, 6, 59, 59))).first()
    assert (row.year, row.month, row.day, row.dow) == (2017, 11, 4, 7)


def test_minute_snapshot_is_half_open_and_crosses_midnight(spark, rows):
    at = datetime(2017, 11, 4, 0, 0, 30)
    utc = at + timedelta(hours=7)
    df = _utc(spark, utc, utc - timedelta(minutes=1), utc - timedelta(seconds=59), utc + timedelta(seconds=1),
              utc - timedelta(seconds=30))
    for frame in (with_calendar(df), with_localtime(df)):
        assert rows(snapshot(frame, at), "seq") == [(0,), (2,), (4,)]


def test_hour_snapshot_at_minute_zero(spark, rows):
    at = datetime(2017, 11, 3, 0, 0, 0)
    df = with_calendar(_utc(spark, *[at + timedelta(hours=7, minutes=m) for m in (-60, -59, 0, 1)]))
    assert rows(snapshot(df, at, timedelta(hours=1)), "seq") == [(1,), (2,)]


def test_slots_tile_time_like_the_snapshot(spark):
    t = datetime(2017, 11, 3, 17, 58, 0)
    df = _utc(spark, t, t + timedelta(microseconds=1), t + timedelta(seconds=59), t + timedelta(seconds=60))
    ends = [r.e for r in df.select("seq", slot_end(F.col("base_dt"), 60).alias("e")).orderBy("seq").collect()]
    assert ends == [t] + [t + timedelta(minutes=1)] * 3


def test_epoch_millis_counts_the_wall_clock(spark):
    df = _utc(spark, datetime(1970, 1, 2, 0, 0, 1))
    assert df.select(epoch_millis(F.col("base_dt")).alias("m")).first().m == 86_401_000


def test_speed_limits(spark, rows):
    df = spark.createDataFrame([(s,) for s in (None, 0.0, 0.9, 1.0, 3.9, 4.0)], "sog double")
    assert rows(moving(df)) == [(4.0,)]
    assert rows(stationary(df)) == [(0.0,), (0.9,), (1.0,), (3.9,)]
    assert rows(in_motion(df)) == [(1.0,), (3.9,), (4.0,)]


def test_float_speeds_compare_as_sent(spark, rows):
    df = spark.createDataFrame([(4.1,)], "sog float")
    assert rows(clean_speeds(df).where("sog = 4.1D")) == [(4.1,)]


def test_near_place_and_time_uses_utc_and_local_days(spark, rows):
    times = [START + timedelta(hours=h) for h in range(0, 12, 3)]
    df = spark.createDataFrame(
        [(i, 1, t, 48.0, -122.5, 5.0, 0.0, None, None) for i, t in enumerate(times)], SCHEMA
    )
    near = near_place_and_time(with_calendar(df), times[1], times[2], 47.5, 48.0, -122.5, -122.0)
    assert rows(near, "seq") == [(1,), (2,)]


def test_sample_period_is_half_open_on_local_time(spark, rows):
    df = with_localtime(_utc(spark, datetime(2017, 10, 1, 6, 59, 59), datetime(2017, 10, 1, 7), datetime(2018, 1, 1, 8)))
    assert rows(sample_period(df), "seq") == [(1,)]


def test_random_vessels_are_distinct_and_repeatable(spark, rows):
    df = spark.range(200).select((F.col("id") % 40).cast("int").alias("mmsi"))
    first, again = rows(random_vessels(df, 1)), rows(random_vessels(df.repartition(7), 1))
    assert first == again and len(set(first)) == 10
    assert first != rows(random_vessels(df, 2))


def test_literals_keep_microseconds(spark):
    t = datetime(2017, 11, 3, 1, 2, 3, 4)
    assert spark.range(1).select(ntz(t).alias("t")).first().t == t
