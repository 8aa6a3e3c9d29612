from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import SCHEMA, START, track
from wakeline.functions.timefn import ntz, slot_end
from wakeline.operators.geosets import latest_positions
from wakeline.streaming.live import LateRows, last_hour_activity, latest_by_slot, replay, run_to_end, run_to_table
from wakeline.streaming.retained import retained_points, retained_track, run_retained


def ordered(spark, tmp_path, *batches):
    """A stream that reads one file per batch, in the order given."""
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_latest_by_slot_equals_batch_on_closed_slots(spark, tmp_path, rows):
    first = track(spark, 1, [(s, 5.0) for s in range(0, 1800, 20)])
    second = track(spark, 2, [(s, 5.0) for s in range(300, 1800, 50)], first_seq=1000)
    both = first.unionByName(second)
    found = run_to_table(latest_by_slot(ordered(spark, tmp_path, both)), "latest")
    slots = both.withColumn("slot_start", slot_end(F.col("base_dt") + F.expr("INTERVAL '0.000001' SECOND"), 60) - F.expr("INTERVAL 1 MINUTE"))
    want = latest_positions(slots, ("slot_start",)).select("slot_start", "mmsi", "lat", "lon")
    closed = START + timedelta(seconds=1780) - timedelta(minutes=11)
    assert rows(found) == rows(want.where(F.col("slot_start") <= ntz(closed))) != []


def test_late_rows_are_dropped(spark, tmp_path):
    on_time = track(spark, 1, [(3600, 5.0)])
    # The limit for late rows is the watermark of the batch before the last.
    more = track(spark, 1, [(3600, 5.0)], first_seq=5, lat=49.0)
    late = track(spark, 1, [(0, 5.0)], first_seq=10)
    end = track(spark, 1, [(9000, 5.0)], first_seq=20)
    found = run_to_table(latest_by_slot(ordered(spark, tmp_path, on_time, more, late, end)), "latest").collect()
    assert [(r.slot_start, r.lat) for r in found] == [(START + timedelta(hours=1), 49.0)]


def test_last_hour_activity(spark, tmp_path):
    df = track(spark, 1, [(0, 5.0), (1800, 5.0), (9000, 5.0)])
    found = {r.window_end: r for r in run_to_table(last_hour_activity(ordered(spark, tmp_path, df)), "hour").collect()}
    assert found[START + timedelta(minutes=30)].n_points == 1
    assert found[START + timedelta(minutes=31)].n_points == 2
    assert found[START + timedelta(minutes=61)].n_points == 1
    assert START + timedelta(minutes=151) not in found


def test_open_windows_come_out_too(spark, tmp_path, rows):
    df = track(spark, 1, [(s, 5.0) for s in range(0, 7200, 45)])
    live = ordered(spark, tmp_path, df)
    slots = run_to_end(latest_by_slot(live), latest_by_slot(df), F.col("slot_start") + F.expr("INTERVAL 1 MINUTE"), "slots")
    assert rows(slots) == rows(latest_by_slot(df)) and slots.count() == 120
    hours = run_to_end(last_hour_activity(live), last_hour_activity(df), F.col("window_end"), "hours")
    assert rows(hours) == rows(last_hour_activity(df))


def overlapping(spark):
    """Five files' worth of messages, each over the whole period."""
    return [track(spark, i % 2, [(s + 11 * i, 5.0) for s in range(0, 7200, 90)], first_seq=1000 * i) for i in range(5)]


def test_a_replay_in_time_order_drops_nothing(spark, tmp_path, rows):
    files = overlapping(spark)
    unordered = ordered(spark, tmp_path, *files)
    df = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    assert run_to_table(latest_by_slot(unordered), "lost").count() < latest_by_slot(df).count()
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, and so several batches
    try:
        live, still = replay(df, "replay", files_per_batch=1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(still.inputFiles()) > 2 and rows(still.select(df.columns)) == rows(df)
    slots = run_to_end(latest_by_slot(live), latest_by_slot(still), F.col("slot_start") + F.expr("INTERVAL 1 MINUTE"), "slots")
    assert rows(slots) == rows(latest_by_slot(df)) != []
    hours = run_to_end(last_hour_activity(live), last_hour_activity(still), F.col("window_end"), "hours")
    assert rows(hours) == rows(last_hour_activity(df)) != []
    assert sum(r.n_points for r in hours.collect()) == 60 * df.count()


def test_late_rows_are_reported_however_long_ago(spark, tmp_path):
    files = [track(spark, 1, [(s, 5.0)], first_seq=10 * i) for i, s in enumerate((3600, 3600, 3601, 0, 9000, 9001, 9002))]
    live = ordered(spark, tmp_path, *files)
    df = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with pytest.raises(LateRows):
            run_to_end(latest_by_slot(live), latest_by_slot(df), F.col("slot_start") + F.expr("INTERVAL 1 MINUTE"), "slots")
        assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "2"
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def last_hours(points):
    """(mmsi, idx, base_dt, lat, lon, sog) of plain rows."""
    out = []
    for mmsi in {p.mmsi for p in points if p.mmsi is not None}:
        own = sorted((p for p in points if p.mmsi == mmsi and None not in (p.base_dt, p.lat, p.lon)), key=lambda p: (p.base_dt, p.seq))
        own = [p for p in own if p.base_dt > own[-1].base_dt - timedelta(hours=1)]
        out += [(mmsi, i, p.base_dt, p.lat, p.lon, p.sog) for i, p in enumerate(own)]
    return sorted(out, key=repr)


def test_retained_tracks_of_a_replay_in_any_order(spark, tmp_path, rows):
    files = [
        track(spark, 1, [(9000, 5.0), (8000, None), (5400.5, 3.0), (5400, 4.0)], first_seq=0),
        track(spark, 2, [(0, 1.0), (10, 2.0)], first_seq=10),
        track(spark, 1, [(5399, 1.0), (9300, 2.0), (5700, 7.0), (5701, 7.0)], first_seq=20),
        track(spark, 1, [(100, 1.0), (9300, 2.5)], first_seq=30),  # one far too old
        track(spark, 2, [(7200, 1.0)], first_seq=40),  # the first two fall behind
        track(spark, 3, [(50, 1.0)], first_seq=50).withColumn("lat", F.lit(None).cast("double")),
        track(spark, 4, [(60, 1.0)], first_seq=60).withColumn("mmsi", F.lit(None).cast("int")),
    ]
    live = ordered(spark, tmp_path, *files)
    place = str(tmp_path / "state")
    run_retained(retained_track(live), place)
    df = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    assert rows(retained_points(spark, place)) == last_hours(df.collect())
    # A later run goes on from the state.
    ordered(spark, tmp_path, track(spark, 2, [(7300, 3.0), (3700.25, 1.0)], first_seq=70), track(spark, 5, [(1, 2.0)], first_seq=80))
    run_retained(retained_track(live), place)
    df = spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))
    assert rows(retained_points(spark, place)) == last_hours(df.collect()) != []


def test_state_does_not_grow_with_the_replay(spark, tmp_path):
    def held(hours):
        place = tmp_path / str(hours)
        live = ordered(spark, place, *[track(spark, 1, [(3600 * h + s, 5.0) for s in range(0, 3600, 60)], first_seq=100 * h) for h in range(hours)])
        run_retained(retained_track(live), str(place / "state"))
        state = spark.read.format("statestore").option("stateVarName", "track").load(str(place / "state"))
        return state.agg(F.sum(F.size("user_map_value.points"))).first()[0]

    assert held(2) == held(5) <= 70
