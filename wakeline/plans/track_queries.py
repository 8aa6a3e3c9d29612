"""Registered queries on tracks, speed classes, segments and time series."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wakeline.functions.codes import speed_colour
from wakeline.operators.days import speed_statistics_of_days, write_speed_days
from wakeline.operators.geosets import MOVING, geo_sets, members
from wakeline.operators.parts import attach_per_vessel, with_part
from wakeline.operators.series import (
    last_hour_lines,
    latest_samples,
    long_series,
    of_vessels,
    retain,
    series_range,
)
from wakeline.operators.tracks import (
    build_tracks,
    classed_points,
    lat_lon_points,
    minute_differences,
    moving_points,
    parallel_arrays,
    points_at,
    segment_summary,
    speed_polylines,
    speed_segments,
    speed_statistics,
    split_at,
    track_points,
)
from wakeline.plans.message_queries import calendar, hour_rows, minute_rows, motion
from wakeline.plans.registry import (
    CLASSED_SQL,
    HOUR_SQL,
    QUINTILE_SQL,
    on_calendar,
    on_minute,
    on_motion,
    on_segments,
    register,
)
from wakeline.schema import SPEED_COLOURS
from wakeline.sources.appended import append_tracks, appended_tracks
from wakeline.sources.scratch import scratch_path

PLACE = "row_number() OVER (PARTITION BY mmsi ORDER BY base_dt, seq) - 1 AS idx"


def tracks(spark, sf_dir):
    return build_tracks(motion(spark, sf_dir))


@register(
    "a1_build_tracks",
    on_motion(f"SELECT mmsi, {PLACE}, base_dt, seq, lat, lon, sog, cog, heading, status FROM motion"),
)
def a1(spark, sf_dir):
    return track_points(tracks(spark, sf_dir)).drop("part")


@register(
    "a1_appended_tracks",
    on_motion(f"SELECT mmsi, {PLACE}, base_dt, seq, lat, lon, sog, cog, heading, status FROM motion"),
)
def a1_appended(spark, sf_dir):
    """The same table from three appends, the last of which holds messages of all hours."""
    path = scratch_path(spark, "appended")
    rows = motion(spark, sf_dir)
    late, noon = F.col("seq") % 16 == 0, F.expr("TIMESTAMP_NTZ'2017-11-05 08:00:00'")
    for some in (rows.where(~late & (F.col("base_dt") < noon)), rows.where(~late & (F.col("base_dt") >= noon)), rows.where(late)):
        append_tracks(some, path)
    return track_points(appended_tracks(spark, path)).drop("part")


@register(
    "a1_parallel_arrays",
    on_motion(f"SELECT mmsi, {PLACE}, base_dt, lat, lon, sog, status FROM motion"),
)
def a1_parallel(spark, sf_dir):
    arrays = parallel_arrays(tracks(spark, sf_dir))
    zipped = F.arrays_zip("base_dts", "lats", "lons", "sogs", "statuses")
    return arrays.select("mmsi", "first_idx", F.posexplode(zipped).alias("pos", "p")).select(
        "mmsi",
        (F.col("first_idx") + F.col("pos")).alias("idx"),
        F.col("p.base_dts").alias("base_dt"),
        F.col("p.lats").alias("lat"),
        F.col("p.lons").alias("lon"),
        F.col("p.sogs").alias("sog"),
        F.col("p.statuses").alias("status"),
    )


def _statistics(name, columns):
    @register(name, on_motion(f"SELECT mmsi, {', '.join(columns)} FROM quintiles", QUINTILE_SQL))
    def run(spark, sf_dir):
        return speed_statistics(motion(spark, sf_dir)).select("mmsi", *columns)


_statistics("a4_max_speed", ["max_sog"])
_statistics("a5_median_speed", ["median_sog"])
_statistics("a6_speed_quintiles", ["q20", "q40", "q60", "q80"])


@register("a6_speed_quintiles_of_days", on_motion("SELECT mmsi, max_sog, median_sog, q20, q40, q60, q80 FROM quintiles", QUINTILE_SQL))
def a6_days(spark, sf_dir):
    path = scratch_path(spark, "speed-days")
    write_speed_days(motion(spark, sf_dir), path)
    return speed_statistics_of_days(spark, path)



@register(
    "j8_points_with_cut_points",
    on_motion(
        "SELECT m.mmsi, seq, sog, q20, q40, q60, q80 FROM motion m JOIN quintiles q ON m.mmsi = q.mmsi",
        QUINTILE_SQL,
    ),
)
def j8(spark, sf_dir):
    rows = motion(spark, sf_dir)
    cuts = speed_statistics(rows).select("mmsi", "q20", "q40", "q60", "q80")
    return attach_per_vessel(with_part(rows), cuts).select(
        "mmsi", "seq", "sog", "q20", "q40", "q60", "q80"
    )


@register(
    "w1_speed_class",
    on_motion("SELECT mmsi, seq, sog, speed_class FROM classed", QUINTILE_SQL, CLASSED_SQL),
)
def w1(spark, sf_dir):
    rows = motion(spark, sf_dir)
    return classed_points(rows).select("mmsi", "seq", "sog", "speed_class")


def segments(spark, sf_dir):
    return speed_segments(motion(spark, sf_dir))


@register("w2_gap_flags", on_segments("SELECT mmsi, seq, speed_class, gap FROM segments"))
def w2(spark, sf_dir):
    return segments(spark, sf_dir).select("mmsi", "seq", "speed_class", "gap")


@register("w3_segment_numbers", on_segments("SELECT mmsi, seq, speed_class, segment FROM segments"))
def w3(spark, sf_dir):
    return segments(spark, sf_dir).select("mmsi", "seq", "speed_class", "segment")


LINE_ROWS = (
    "SELECT mmsi, speed_class, segment, row_number() OVER (PARTITION BY mmsi, speed_class, segment "
    "ORDER BY base_dt, seq) - 1 AS idx, lat, lon FROM segments"
)


@register("w4_speed_polylines", on_segments(LINE_ROWS))
def w4(spark, sf_dir):
    lines = speed_polylines(speed_segments(motion(spark, sf_dir), before=True))
    points = lines.select("mmsi", "speed_class", "segment", "first_idx", F.posexplode("points").alias("pos", "p"))
    return points.select("mmsi", "speed_class", "segment", (F.col("first_idx") + F.col("pos")).alias("idx"), "p.*")


@register(
    "x3_segment_summary",
    on_segments(
        "SELECT mmsi, speed_class, segment, count(*) AS n_points, min(base_dt) AS first_dt, max(base_dt) AS last_dt "
        "FROM segments GROUP BY mmsi, speed_class, segment"
    ),
)
def x3(spark, sf_dir):
    return segment_summary(segments(spark, sf_dir))


@register(
    "u2_class_colours",
    on_segments(
        "SELECT speed_class, CASE speed_class "
        + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(SPEED_COLOURS))
        + " END AS colour, count(*) AS n FROM segments GROUP BY speed_class"
    ),
)
def u2(spark, sf_dir):
    rows = motion(spark, sf_dir)
    counted = classed_points(rows).groupBy("speed_class").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("speed_class", speed_colour(F.col("speed_class")).alias("colour"), "n")


# --- array functions ------------------------------------------------------------------


@register(
    "p7_in_motion_arrays",
    on_motion("SELECT mmsi, base_dt, seq, sog FROM motion WHERE sog >= 1"),
)
def p7_arrays(spark, sf_dir):
    kept = tracks(spark, sf_dir).withColumn("points", moving_points(F.col("points")))
    return track_points(kept).select("mmsi", "base_dt", "seq", "sog")


@register(
    "f13_points_at_indexes",
    on_motion(
        "SELECT mmsi, idx, lat, lon FROM (SELECT *, count(*) OVER (PARTITION BY mmsi) AS n, "
        "row_number() OVER (PARTITION BY mmsi ORDER BY base_dt, seq) - 1 AS place FROM motion) "
        "JOIN (VALUES (0, 'first'), (1, 'last')) AS t(k, idx) "
        "ON (k = 0 AND place = 0) OR (k = 1 AND place = n - 1)"
    ),
)
def f13(spark, sf_dir):
    # Places in the whole track, as seen from the part; those in other parts come out NULL here.
    ends = F.array(-F.col("first_idx"), F.col("n_points") - 1 - F.col("first_idx")).cast("array<int>")
    picked = tracks(spark, sf_dir).select("mmsi", F.posexplode(points_at(F.col("points"), ends)).alias("k", "p"))
    return picked.where("p IS NOT NULL").select("mmsi", F.when(F.col("k") == 0, "first").otherwise("last").alias("idx"), "p.lat", "p.lon")


@register(
    "f14_minute_differences",
    on_motion(
        "SELECT mmsi, place - 1 AS idx, round(epoch_us(base_dt - before) / 60e6, 6) AS minutes FROM ("
        "SELECT *, lag(base_dt) OVER v AS before, row_number() OVER v - 1 AS place "
        "FROM motion WINDOW v AS (PARTITION BY mmsi ORDER BY base_dt, seq)) WHERE before IS NOT NULL"
    ),
)
def f14(spark, sf_dir):
    steps = minute_differences(F.col("points")["base_dt"], F.col("before_dt"))
    first = F.col("first_idx") - F.col("before_dt").isNotNull().cast("bigint")
    return (
        tracks(spark, sf_dir)
        .select("mmsi", first.alias("first"), F.posexplode(steps).alias("pos", "minutes"))
        .select("mmsi", (F.col("first") + F.col("pos")).alias("idx"), F.round("minutes", 6).alias("minutes"))
    )


@register(
    "f15_split_at_gaps",
    on_motion(
        "SELECT mmsi, CAST(piece AS BIGINT) AS piece, count(*) AS n FROM ("
        "SELECT mmsi, sum(cut) OVER (PARTITION BY mmsi ORDER BY base_dt, seq ROWS UNBOUNDED PRECEDING) AS piece FROM ("
        "SELECT *, CASE WHEN base_dt - lag(base_dt) OVER (PARTITION BY mmsi ORDER BY base_dt, seq) > INTERVAL 2 MINUTE "
        "THEN 1 ELSE 0 END AS cut FROM motion)) GROUP BY ALL"
    ),
)
def f15(spark, sf_dir):
    shift = F.when(F.col("before_dt").isNull(), 1).otherwise(0)
    places = F.filter(
        F.transform(
            minute_differences(F.col("points")["base_dt"], F.col("before_dt")),
            lambda minutes, i: F.when(minutes > 2.0, i + shift),
        ),
        lambda i: i.isNotNull(),
    )
    cut = tracks(spark, sf_dir).select("mmsi", "part", "points", places.alias("places"))
    earlier = W.partitionBy("mmsi").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = cut.select("mmsi", "part", F.size("places").alias("n")).select(
        "mmsi", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    pieces = cut.join(before, ["mmsi", "part"]).select(
        "mmsi", "before", F.posexplode(split_at(F.col("points"), F.col("places"))).alias("pos", "p")
    )
    # A piece that goes on over a part's edge is counted in both parts.
    sized = pieces.select("mmsi", (F.col("before") + F.col("pos")).alias("piece"), F.size("p").alias("n"))
    return sized.groupBy("mmsi", "piece").agg(F.sum("n").alias("n"))


@register("f16_zip_lat_lon", on_motion(f"SELECT mmsi, {PLACE}, lat, lon FROM motion"))
def f16(spark, sf_dir):
    points = lat_lon_points(F.col("lats"), F.col("lons"))
    return (
        parallel_arrays(tracks(spark, sf_dir))
        .select("mmsi", "first_idx", F.posexplode(points).alias("pos", "p"))
        .select("mmsi", (F.col("first_idx") + F.col("pos")).alias("idx"), "p.*")
    )


@register("f17_array_max", on_motion("SELECT mmsi, max(sog) AS max_sog FROM motion GROUP BY mmsi"))
def f17(spark, sf_dir):
    per_part = tracks(spark, sf_dir).select("mmsi", F.array_max(F.col("points")["sog"]).alias("m"))
    return per_part.groupBy("mmsi").agg(F.max("m").alias("max_sog"))


# --- series ---------------------------------------------------------------------------

LONG_SQL = """series AS (
 SELECT mmsi, base_dt, seq, CAST(epoch_us(localtime_) // 1000000 * 1000 AS BIGINT) AS ts_ms, 'Lat' AS label, lat AS value FROM cal
 UNION ALL SELECT mmsi, base_dt, seq, CAST(epoch_us(localtime_) // 1000000 * 1000 AS BIGINT), 'Lon', lon FROM cal)"""


@register(
    "w5_retention",
    on_motion(
        "SELECT mmsi, seq, base_dt FROM (SELECT *, max(base_dt) OVER (PARTITION BY mmsi) AS newest FROM motion) "
        "WHERE base_dt >= newest - INTERVAL 1 HOUR"
    ),
)
def w5(spark, sf_dir):
    return retain(motion(spark, sf_dir)).select("mmsi", "seq", "base_dt")


@register("t4_long_series", on_calendar("SELECT mmsi, seq, base_dt, label, ts_ms, value FROM series", LONG_SQL))
def t4(spark, sf_dir):
    return long_series(calendar(spark, sf_dir)).select("mmsi", "seq", "base_dt", "label", "ts_ms", "value")


@register(
    "t5_series_range",
    on_calendar("SELECT label, ts_ms, value FROM series WHERE mmsi = 366000007 AND label = 'Lat' ORDER BY base_dt, seq", LONG_SQL),
)
def t5(spark, sf_dir):
    return series_range(long_series(calendar(spark, sf_dir)), 366000007, "Lat").select("label", "ts_ms", "value")


@register(
    "t7_latest_samples",
    on_calendar(
        "SELECT mmsi, label, last(ts_ms ORDER BY base_dt, seq) AS ts_ms, "
        "last(value ORDER BY base_dt, seq) AS value FROM series GROUP BY mmsi, label",
        LONG_SQL,
    ),
)
def t7(spark, sf_dir):
    return latest_samples(long_series(calendar(spark, sf_dir)))


HOUR_OF_MOVING = "FROM hour_rows WHERE mmsi IN (SELECT mmsi FROM minute_rows WHERE sog >= 4)"


def _moving_now(spark, sf_dir):
    return members(geo_sets(minute_rows(spark, sf_dir)), MOVING)


@register("j4_hour_of_moving", on_minute(f"SELECT mmsi, seq, base_dt, lat, lon {HOUR_OF_MOVING}", HOUR_SQL))
def j4(spark, sf_dir):
    rows = of_vessels(hour_rows(spark, sf_dir), _moving_now(spark, sf_dir))
    return rows.select("mmsi", "seq", "base_dt", "lat", "lon")


@register("t6_last_hour_lines", on_minute(f"SELECT mmsi, {PLACE}, lat, lon {HOUR_OF_MOVING}", HOUR_SQL))
def t6(spark, sf_dir):
    lines = last_hour_lines(hour_rows(spark, sf_dir), _moving_now(spark, sf_dir))
    return track_points(lines).select("mmsi", "idx", "lat", "lon")
