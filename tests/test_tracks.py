from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import START, track
from wakeline.operators import parts
from wakeline.operators.parts import with_part, without_id
from wakeline.operators.series import retain
from wakeline.operators.tracks import (
    build_tracks,
    classed_points,
    minute_differences,
    parallel_arrays,
    segment_summary,
    speed_polylines,
    speed_segments,
    speed_statistics,
    track_points,
)


def test_values_of_a_message_stay_together(spark):
    df = track(spark, 1, [(20, 3.0), (0, None), (10, 2.0)])
    arrays = parallel_arrays(build_tracks(df)).first()
    assert arrays.sogs == [None, 2.0, 3.0]
    assert arrays.lats == [48.001, 48.002, 48.0]
    assert {len(arrays[c]) for c in ("base_dts", "lats", "lons", "sogs", "cogs", "headings", "statuses")} == {3}


def test_ties_in_time_follow_seq(spark, rows):
    df = track(spark, 1, [(0, 1.0), (0, 2.0), (0, 3.0)]).repartition(3)
    assert rows(track_points(build_tracks(df)), "idx", "seq") == [(0, 0), (1, 1), (2, 2)]


def test_statistics_match_numpy(spark):
    rng = np.random.default_rng(5)
    speeds = [round(float(x), 1) for x in rng.uniform(0, 20, 301)]
    stats = speed_statistics(track(spark, 1, list(enumerate(speeds)))).first()
    fast = np.array([s for s in speeds if s >= 1.0])
    assert stats.max_sog == max(speeds)
    assert stats.median_sog == pytest.approx(np.percentile(fast, 50), abs=1e-6)
    assert [stats.q20, stats.q40, stats.q60, stats.q80] == pytest.approx(np.percentile(fast, [20, 40, 60, 80]), abs=1e-6)


def test_vessel_that_never_moves_has_no_classes(spark, rows):
    df = track(spark, 1, [(0, 0.0), (60, 0.9)])
    stats = speed_statistics(df).first()
    assert (stats.max_sog, stats.median_sog, stats.q20) == (0.9, None, None)
    assert rows(speed_segments(df)) == []


def test_class_edges(spark, rows):
    # Cut points of 1..6 are exactly 2, 3, 4, 5.
    df = track(spark, 1, [(i * 60, s) for i, s in enumerate([0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None, -1.0])])
    assert rows(classed_points(df), "sog", "speed_class") == [
        (0.0, 0), (1.0, 0), (2.0, 1), (3.0, 2), (4.0, 3), (5.0, 4), (6.0, 4)
    ]


def test_all_speeds_equal_is_the_top_class(spark, rows):
    df = track(spark, 1, [(0, 5.0), (60, 5.0)])
    assert rows(classed_points(df), "speed_class") == [(4,), (4,)]


def test_gap_is_strictly_more_than_two_minutes(spark, rows):
    df = track(spark, 1, [(0, 5.0), (120, 5.0), (241, 5.0), (241, 5.0)])
    assert rows(speed_segments(df), "seq", "gap", "segment") == [
        (0, False, 0), (1, False, 0), (2, True, 1), (3, False, 1)
    ]


def test_gap_is_counted_inside_a_class(spark, rows):
    speeds = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 0.5]
    df = track(spark, 1, [(i * 20, s) for i, s in enumerate(speeds)])
    lowest = speed_segments(df).where("speed_class = 0")
    # Away and back within two minutes continues the same segment.
    assert rows(lowest, "seq", "segment") == [(0, 0), (6, 0)]


def test_single_point_line(spark):
    line = speed_polylines(speed_segments(track(spark, 1, [(0, 5.0)]))).first()
    assert [(p.lat, p.lon) for p in line.points] == [(48.0, -122.5)]


def _busy(spark):
    """One vessel with most of the rows, in bursts and pauses, next to quiet ones."""
    rng = np.random.default_rng(11)
    t, steps = 0, []
    for _ in range(1500):
        t += int(rng.choice([0, 1, 3, 60, 119, 120, 121, 300], p=[0.1, 0.3, 0.3, 0.1, 0.05, 0.05, 0.05, 0.05]))
        speed = rng.choice([None, -0.1, *np.round(rng.uniform(0, 15, 6), 1)])
        steps.append((t, None if speed is None else float(speed)))
    frames = track(spark, 1, steps)
    for m in range(2, 6):
        frames = frames.unionByName(track(spark, m, steps[m * 10 : m * 10 + 40], first_seq=m * 10_000))
    return frames


@pytest.mark.parametrize("seconds", [1, 60, 3600])
@pytest.mark.parametrize("shuffled", [False, True])
def test_the_time_step_does_not_change_results(spark, rows, monkeypatch, shuffled, seconds):
    if shuffled:  # too many vessels for a broadcast
        monkeypatch.setattr(parts, "BROADCAST_ROWS", 0)
    df = _busy(spark)
    whole = 10**9
    assert with_part(df, seconds).select("part").distinct().count() > 1
    assert with_part(df, whole).select("part").distinct().count() == 1

    columns = ("mmsi", "seq", "speed_class", "gap", "segment")
    cut, uncut = speed_segments(df, seconds=seconds), speed_segments(df, seconds=whole)
    assert rows(cut, *columns) == rows(uncut, *columns)
    assert rows(segment_summary(cut)) == rows(segment_summary(uncut))

    places = ("mmsi", "idx", "seq")
    points = rows(track_points(build_tracks(df, seconds)), *places)
    assert points == rows(track_points(build_tracks(df, whole)), *places)
    assert [idx for mmsi, idx, _ in points if mmsi == 2] == sorted(range(40), key=lambda i: repr((2, i)))

    def lines(segments):
        each = speed_polylines(segments).select("*", F.posexplode("points").alias("pos", "p"))
        return rows(each, "mmsi", "speed_class", "segment", F.col("first_idx") + F.col("pos"), "p.lat", "p.lon")

    assert lines(cut) == lines(uncut)
    # Places that come with the segments are those that a second look at the segments gives.
    assert lines(speed_segments(df, seconds=seconds, before=True)) == lines(uncut)


def test_differences_cross_the_edges_of_steps(spark):
    df = track(spark, 1, [(0, 5.0), (90, 5.0), (4000, 5.0), (4030, 5.0)])
    parts_ = build_tracks(df, 60).orderBy("part")
    found = parts_.select(minute_differences(F.col("points")["base_dt"], F.col("before_dt")).alias("d")).collect()
    assert [x for r in found for x in r.d] == pytest.approx([1.5, 3910 / 60, 0.5])


def test_a_burst_makes_no_more_parts_than_steps(spark):
    df = track(spark, 1, [(0, 5.0)] * 300 + [(i * 60, 5.0) for i in range(120)])
    assert build_tracks(df).count() == 2
    assert build_tracks(df).agg(F.sum(F.size("points")), F.max("n_points")).first() == (420, 420)


def test_rows_without_id_belong_to_no_vessel(spark, rows):
    df = track(spark, 1, [(0, 5.0), (60, 6.0)])
    both = df.unionByName(df.withColumn("mmsi", F.lit(None).cast("int")))
    assert without_id(both).count() == 2
    assert rows(track_points(build_tracks(both)), "mmsi", "idx") == [(1, 0), (1, 1)]
    assert rows(speed_segments(both), "mmsi") == [(1,), (1,)]
    assert rows(retain(both), "mmsi") == [(1,), (1,)]


def test_fractions_of_a_second_count(spark, rows):
    df = track(spark, 1, [(0, 5.0), (120.5, 5.0), (240.5, 5.0)])
    assert rows(speed_segments(df), "seq", "gap") == [(0, False), (1, True), (2, False)]
    late = track(spark, 1, [(0, 5.0), (0.6, 5.0), (3600.5, 5.0)])
    assert rows(retain(late), "seq") == [(1,), (2,)]


def test_segments_cover_all_classed_points(spark):
    df = _busy(spark)
    total = segment_summary(speed_segments(df)).agg(F.sum("n_points")).first()[0]
    assert total == df.where("sog >= 0").count()


def test_retention_keeps_the_edge(spark, rows):
    df = track(spark, 1, [(0, 5.0), (1, 5.0), (3601, 5.0)])
    assert rows(retain(df), "seq") == [(1,), (2,)]
    assert df.agg(F.min("base_dt")).first()[0] == START
    assert START + timedelta(seconds=3601) == df.agg(F.max("base_dt")).first()[0]
