"""Tracks: ordered points per vessel, speed statistics, classes and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wakeline.functions.timefn import micros_between, more_than
from wakeline.operators.motion import order_key
from wakeline.operators.parts import attach_per_vessel, part_places, with_part
from wakeline.schema import GAP_SECONDS, IN_MOTION_KNOTS, MOTION_COLUMNS, PART_SECONDS, QUINTILES

# Struct field -> array column of the parallel form.
ARRAY_NAMES = {
    "base_dt": "base_dts",
    "lat": "lats",
    "lon": "lons",
    "sog": "sogs",
    "cog": "cogs",
    "heading": "headings",
    "status": "statuses",
}


def build_tracks(motion: DataFrame, seconds: int = PART_SECONDS) -> DataFrame:
    """(mmsi, part, first_idx, n_points, before_dt, points): a vessel's points in time order, a row for
    each time step, one struct per message so that the values of a message stay together even
    where some are NULL. ``first_idx`` is the place of the first point in the whole track, ``n_points``
    the whole track's size, ``before_dt`` the newest time of the steps before."""
    keys = order_key(motion)
    fields = keys + [c for c in MOTION_COLUMNS if c != "mmsi" and c not in keys]
    points = F.sort_array(F.collect_list(F.struct(*[c for c in fields if c in motion.columns])))
    parts = with_part(motion, seconds)
    places = part_places(parts, "mmsi")
    return (
        parts.groupBy("mmsi", "part")
        .agg(points.alias("points"))
        .join(places, ["mmsi", "part"])
        .select("mmsi", "part", "first_idx", "n_points", "before_dt", "points")
    )


def parallel_arrays(tracks: DataFrame) -> DataFrame:
    """The same tracks as seven arrays of equal length."""
    return tracks.select(
        "mmsi", "part", "first_idx", *[F.col("points")[field].alias(name) for field, name in ARRAY_NAMES.items()]
    )


def track_points(tracks: DataFrame) -> DataFrame:
    """One row per point with its place ``idx`` in the vessel's whole track."""
    return tracks.select("mmsi", "part", "first_idx", F.posexplode("points").alias("_pos", "p")).select(
        "mmsi", "part", (F.col("first_idx") + F.col("_pos")).alias("idx"), "p.*"
    )


# --- array forms, for tracks already stored as arrays ---------------------------------


def moving_points(points: Column, knots: float = IN_MOTION_KNOTS) -> Column:
    return F.filter(points, lambda p: p["sog"] >= knots)


def points_at(points: Column, indexes: Column) -> Column:
    """Elements at the given 0-based places."""
    return F.transform(indexes, lambda i: F.get(points, i))


def minute_differences(times: Column, before: Column | None = None) -> Column:
    """Difference of each time to the one before, in minutes; one shorter than the input, or as
    long where ``before`` gives the time before the first."""
    if before is not None:
        times = F.when(before.isNull(), times).otherwise(F.concat(F.array(before), times))
    ahead = F.slice(times, F.lit(2), F.greatest(F.size(times) - 1, F.lit(0)))
    behind = F.slice(times, F.lit(1), F.greatest(F.size(times) - 1, F.lit(0)))
    return F.zip_with(ahead, behind, lambda later, earlier: micros_between(later, earlier) / 60e6)


def split_at(values: Column, indexes: Column) -> Column:
    """Cuts an array before each of the 0-based places; always one piece more than cuts."""
    starts = F.concat(F.array(F.lit(0)), indexes)
    ends = F.concat(indexes, F.array(F.size(values)))
    bounds = F.arrays_zip(starts.alias("s"), ends.alias("e"))
    return F.transform(bounds, lambda b: F.slice(values, b["s"] + 1, b["e"] - b["s"]))


def lat_lon_points(lats: Column, lons: Column) -> Column:
    """Two arrays as one array of (lat, lon)."""
    return F.zip_with(lats, lons, lambda lat, lon: F.struct(lat.alias("lat"), lon.alias("lon")))


# --- speed statistics -----------------------------------------------------------------


def speed_counts(points: DataFrame) -> DataFrame:
    """(mmsi, sog, n). Speeds come in steps of 0.1 knot from a 10-bit field, so this is at
    most about a thousand rows per vessel however many messages it sent."""
    return points.where(F.col("sog").isNotNull()).groupBy("mmsi", "sog").agg(F.count(F.lit(1)).alias("n"))


def speed_statistics(points: DataFrame, in_motion: float = IN_MOTION_KNOTS) -> DataFrame:
    """Per vessel: maximum over all points; median and quintile cut points, linearly
    interpolated, over points at ``in_motion`` knots or more (NULL if there are none).

    Cut points are rounded to 6 places: with speeds in steps of 0.1 they have two, and a
    speed equal to a cut point must not miss it by the last bit of the interpolation."""
    return statistics_of_counts(speed_counts(points), in_motion)


def statistics_of_counts(counts: DataFrame, in_motion: float = IN_MOTION_KNOTS) -> DataFrame:
    """``speed_statistics`` from (mmsi, sog, n), which may hold a speed of a vessel in several rows."""
    moving = F.when(F.col("sog") >= in_motion, F.col("sog"))
    exact = F.percentile(moving, [0.5, *QUINTILES], F.col("n"))
    return (
        counts.groupBy("mmsi")
        .agg(F.max("sog").alias("max_sog"), exact.alias("cuts"))
        .select(
            "mmsi",
            "max_sog",
            F.round(F.col("cuts")[0], 6).alias("median_sog"),
            *[F.round(F.col("cuts")[i + 1], 6).alias(f"q{int(q * 100)}") for i, q in enumerate(QUINTILES)],
        )
    )


# --- classes, gaps, segments ----------------------------------------------------------


def speed_class(sog: Column) -> Column:
    """0..4 by the vessel's own cut points: below q20, then half-open classes, then q80
    and up. Negative or missing speeds, or missing cut points, have no class."""
    known = (sog >= 0) & F.col("q20").isNotNull()
    return (
        F.when(~known | sog.isNull(), F.lit(None).cast("int"))
        .when(sog < F.col("q20"), 0)
        .when(sog < F.col("q40"), 1)
        .when(sog < F.col("q60"), 2)
        .when(sog < F.col("q80"), 3)
        .otherwise(4)
    )


def classed_points(motion: DataFrame, seconds: int = PART_SECONDS) -> DataFrame:
    """Messages with ``part`` and ``speed_class``; those without a class are left out."""
    cuts = speed_statistics(motion).select("mmsi", "q20", "q40", "q60", "q80")
    joined = attach_per_vessel(with_part(motion, seconds), cuts)
    return (
        joined.withColumn("speed_class", speed_class(F.col("sog")))
        .where(F.col("speed_class").isNotNull())
        .drop("q20", "q40", "q60", "q80")
    )


def with_segments(points: DataFrame, gap_seconds: int = GAP_SECONDS, before: bool = False) -> DataFrame:
    """Adds ``gap`` (more than ``gap_seconds`` since the previous point of the same vessel
    and class) and ``segment``, the running number of gaps, from 0. With ``before`` also the number of points that
    the segment has in earlier parts."""
    keys = ["mmsi", "speed_class", "part"]
    window = W.partitionBy(*keys).orderBy(*order_key(points))
    previous = F.lag("base_dt").over(window)
    own = F.coalesce(more_than(F.col("base_dt"), previous, gap_seconds), F.lit(False))
    local = points.withColumns({"_gap": own, "_at": F.row_number().over(window)})
    running = F.sum(F.col("_gap").cast("int")).over(window.rowsBetween(W.unboundedPreceding, W.currentRow))
    local = local.withColumn("_run", running.cast("int"))

    # One row per part: what the next part needs to know.
    ends = local.groupBy(*keys).agg(
        F.min("base_dt").alias("_from"),
        F.max("base_dt").alias("_till"),
        F.max("_run").alias("_gaps"),
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(F.col("_gap"), F.col("_at"))).alias("_newest"),
    )
    along = W.partitionBy("mmsi", "speed_class").orderBy("part")
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    last = F.last("_till", ignorenulls=True).over(earlier)
    edge = F.coalesce(more_than(F.col("_from"), last, gap_seconds), F.lit(False))
    ends = ends.withColumns({"_edge": edge, "_passed": F.coalesce(F.sum("_n").over(earlier), F.lit(0))})
    so_far = F.coalesce(F.sum(F.col("_gaps") + F.col("_edge").cast("int")).over(earlier), F.lit(0))
    # Where, counted in all points of the class, the newest segment that begins in a part begins.
    begins = F.when(F.col("_newest").isNotNull(), F.col("_passed") + F.col("_newest") - 1).when(
        F.col("_edge") | (F.col("_passed") == 0), F.col("_passed")
    )
    open_since = F.last("_begins", ignorenulls=True).over(earlier)
    carried = F.when(F.col("_edge"), 0).otherwise(F.coalesce(F.col("_passed") - open_since, F.lit(0)))
    ends = ends.withColumn("_begins", begins).select(
        *keys,
        "_edge",
        (so_far + F.col("_edge").cast("int")).cast("int").alias("_offset"),
        carried.cast("bigint").alias("_carried"),
    )
    places = [F.when(F.col("_run") == 0, F.col("_carried")).otherwise(0).alias("before")] if before else []
    return local.join(ends, keys).select(
        *[F.col(c) for c in points.columns],
        (F.col("_gap") | ((F.col("_at") == 1) & F.col("_edge"))).alias("gap"),
        (F.col("_run") + F.col("_offset")).alias("segment"),
        *places,
    )


def speed_segments(
    motion: DataFrame, gap_seconds: int = GAP_SECONDS, seconds: int = PART_SECONDS, before: bool = False
) -> DataFrame:
    """Classed points with gap flags and segment numbers, for all vessels in one plan."""
    return with_segments(classed_points(motion, seconds), gap_seconds, before)


def speed_polylines(segments: DataFrame) -> DataFrame:
    """(mmsi, speed_class, segment, part, first_idx, points): the [lat, lon] line of each segment, a row
    for each time step; ``first_idx`` is the place of the row's first point in the whole line.
    Segments with ``before`` are read once; without it twice: pass a stored table then."""
    keys = ["mmsi", "speed_class", "segment"]
    fields = dict.fromkeys([*order_key(segments.drop("before")), "lat", "lon"])
    ordered = F.sort_array(F.collect_list(F.struct(*fields)))
    line = F.transform(ordered, lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))
    if "before" in segments.columns:
        return segments.groupBy(*keys, "part").agg(F.max("before").alias("first_idx"), line.alias("points"))
    lines = segments.groupBy(*keys, "part").agg(line.alias("points"))
    return lines.join(part_places(segments, *keys), [*keys, "part"]).select(*keys, "part", "first_idx", "points")


def segment_summary(segments: DataFrame) -> DataFrame:
    """Size and ends of each segment, without collecting its points."""
    return segments.groupBy("mmsi", "speed_class", "segment").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min("base_dt").alias("first_dt"),
        F.max("base_dt").alias("last_dt"),
    )
