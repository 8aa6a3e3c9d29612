"""Named position sets, lookups, radius searches, proximity pairs and forecasts."""

from __future__ import annotations

from math import cos, degrees, radians

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geofn import (
    bands_reached,
    cell_band,
    cell_height,
    cell_in_band,
    cells_reached,
    geohash_score,
    haversine,
    horizon_miles,
    with_destination,
)
from wakeline.operators.motion import order_key
from wakeline.schema import (
    BROADCAST_ROWS,
    CELL_ROWS,
    EARTH_RADIUS_MILES,
    HORIZON_MINUTES,
    MARKER_LAT,
    MARKER_LON,
    MOVING_KNOTS,
    RADIUS_MILES,
    UNITS,
)
from wakeline.sources.scratch import materialise

ALL, MOVING, STATIONARY = "all", "moving", "stationary"


def latest_positions(df: DataFrame, keys: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """The last position of each vessel (per ``keys``), with the ``keep`` columns of that
    message."""
    fields = [*dict.fromkeys(["lat", "lon", "base_dt", *keep])]
    last = F.max_by(F.struct(*fields), F.struct(*order_key(df)))
    return (
        df.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .groupBy(*keys, "mmsi")
        .agg(last.alias("_last"))
        .select(*keys, "mmsi", "_last.*")
    )


def in_sets(df: DataFrame, knots: float = MOVING_KNOTS) -> DataFrame:
    """Each message once per set it belongs to: ``all``, and ``moving`` or ``stationary``
    (neither when the speed is missing). One scan feeds all three sets."""
    sets = F.array_compact(
        F.array(
            F.lit(ALL),
            F.when(F.col("sog") >= knots, MOVING),
            F.when(F.col("sog") < knots, STATIONARY),
        )
    )
    return df.withColumn("set_name", F.explode(sets))


def geo_sets(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(set_name, mmsi, lat, lon, ...): one position per vessel in each set. The set is
    chosen before the latest row, so a vessel that crosses the limit is in both."""
    return latest_positions(in_sets(df), ("set_name",), keep)


def members(sets: DataFrame, name: str) -> DataFrame:
    return sets.where(F.col("set_name") == name).drop("set_name")


def lookup(positions: DataFrame, mmsis: list[int]) -> DataFrame:
    return positions.where(F.col("mmsi").isin(mmsis))


def with_score(positions: DataFrame) -> DataFrame:
    return positions.withColumn("score", geohash_score(F.col("lat"), F.col("lon")))


def by_score(positions: DataFrame) -> DataFrame:
    """Members in geohash order."""
    return with_score(positions).orderBy("score", "mmsi")


def first_members(positions: DataFrame, count: int = 10) -> DataFrame:
    return by_score(positions).limit(count)


def nth_member(positions: DataFrame, index: int) -> DataFrame:
    """The member at 0-based ``index`` of the geohash order: a bounded top-k per task."""
    return by_score(positions).offset(index).limit(1)


def pair_distance(positions: DataFrame, first: int, second: int, unit: str = "mi") -> DataFrame:
    """One row with the distance of two members, in a column named after the ``unit`` (mi, km, m or
    ft); NULL if either is missing."""
    per_mile, name_of_unit = UNITS[unit]

    def side(name, mmsi):
        here = F.col("mmsi") == mmsi
        return F.max(F.when(here, F.col(name)))

    both = lookup(positions, [first, second]).agg(
        side("lat", first).alias("lat1"),
        side("lon", first).alias("lon1"),
        side("lat", second).alias("lat2"),
        side("lon", second).alias("lon2"),
    )
    return both.select((haversine(*[F.col(c) for c in both.columns]) * per_mile).alias(name_of_unit))


def within_radius(
    positions: DataFrame,
    centre: DataFrame,
    miles: float = RADIUS_MILES,
    earth: float = EARTH_RADIUS_MILES,
    cell_rows: int | None = None,
) -> DataFrame:
    """Members within ``miles`` of each row of ``centre`` (mmsi, lat, lon), itself
    included, as (centre_mmsi, mmsi, lat, lon, miles).

    Each centre is spread over the few cells its circle touches and meets the positions in
    an equi-join. One centre is a known small side. For many centres pass stored positions and
    ``cell_rows``: cells that hold more are spread over several tasks.
    """
    height = cell_height(miles, earth)
    probes = _probes(
        centre.select(
            F.col("mmsi").alias("centre_mmsi"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon")
        ),
        "_lat",
        "_lon",
        height,
    )
    away = haversine(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon"), earth)
    stored, keys = _placed(positions.select("mmsi", "lat", "lon"), height), ["_band", "_cell"]
    if cell_rows is not None:
        probes, stored, keys = _dealt(probes, stored, keys, "mmsi", cell_rows)
    return (
        stored.join(probes, keys)
        .withColumn("miles", away)
        .where(F.col("miles") <= miles)
        .select("centre_mmsi", "mmsi", "lat", "lon", "miles")
    )


def within(positions: DataFrame, centre: DataFrame, distance: float, unit: str = "mi") -> DataFrame:
    """``within_radius`` with the distance, and the column of distances, in ``unit`` (mi, km, m or ft)."""
    per_mile, name = UNITS[unit]
    found = within_radius(positions, centre, distance / per_mile)
    return found.withColumn("miles", F.col("miles") * per_mile).withColumnRenamed("miles", name)


def within_radius_of_point(
    positions: DataFrame,
    lat: float,
    lon: float,
    miles: float = RADIUS_MILES,
    earth: float = EARTH_RADIUS_MILES,
) -> DataFrame:
    """Members within ``miles`` of a free point. The bounding box is a plain range on the
    columns, so it reaches the scan."""
    reach = degrees(miles / earth) * (1 + 1e-9)
    near = positions.where(F.col("lat").between(lat - reach, lat + reach))
    if abs(lat) + reach < 90:
        span = degrees(miles / earth) / cos(radians(abs(lat) + reach))
        if lon - span >= -180 and lon + span <= 180:
            near = near.where(F.col("lon").between(lon - span, lon + span))
    away = haversine(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"), earth)
    return near.withColumn("miles", away).where(F.col("miles") <= miles)


def _placed(positions: DataFrame, height: float) -> DataFrame:
    band = cell_band(F.col("lat"), height)
    return positions.withColumn("_band", band).withColumn(
        "_cell", cell_in_band(F.col("lon"), F.col("_band"), height)
    )


def _probes(df: DataFrame, lat: str, lon: str, height: float, upward_only: bool = False) -> DataFrame:
    return df.withColumn("_band", F.explode(bands_reached(F.col(lat), height, upward_only))).withColumn(
        "_cell", F.explode(cells_reached(F.col(lat), F.col(lon), F.col("_band"), height))
    )


def _dealt(
    searching: DataFrame, stored: DataFrame, keys: list[str], mmsi: str, cell_rows: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and their join keys, with cells of more than ``cell_rows`` stored rows spread
    over several tasks: the stored side is dealt out, the searching side visits every share."""
    crowded = (
        stored.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > cell_rows)
        .select(*keys, F.ceil(F.col("_n") / cell_rows).cast("int").alias("_shares"))
    )
    crowded = materialise(crowded, "crowded-cells")
    crowded_cells = crowded.count()
    if not crowded_cells:
        return searching, stored, keys
    shares = F.broadcast(crowded) if crowded_cells <= BROADCAST_ROWS else crowded
    stored = (
        stored.join(shares, keys, "left")
        .withColumn("_share", F.pmod(F.xxhash64(mmsi), F.coalesce("_shares", F.lit(1))).cast("int"))
        .drop("_shares")
    )
    searching = (
        searching.join(shares, keys, "left")
        .withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)))
        .drop("_shares")
    )
    return searching, stored, [*keys, "_share"]


def proximity_pairs(
    positions: DataFrame,
    miles: float = RADIUS_MILES,
    slot: str = "slot",
    earth: float = EARTH_RADIUS_MILES,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """All pairs of vessels within ``miles`` in the same slot, as (slot, mmsi_a, mmsi_b,
    miles) with ``mmsi_a < mmsi_b``. ``positions`` has one row per vessel and slot and is
    read more than once: pass a stored table.

    Both sides meet on (slot, band, cell). Each vessel looks only into its own and higher
    bands, so a pair is met once (twice in the same band, where the ids decide). Cells
    with more than ``cell_rows`` vessels in a slot are spread over several tasks.
    """
    height = cell_height(miles, earth)
    stored = _placed(positions.select(slot, "mmsi", "lat", "lon"), height)
    right = stored.select(
        slot,
        "_band",
        "_cell",
        F.col("mmsi").alias("_mmsi"),
        F.col("lat").alias("_lat"),
        F.col("lon").alias("_lon"),
    )
    left = _probes(
        positions.select(slot, "mmsi", "lat", "lon").withColumn("_home", cell_band(F.col("lat"), height)),
        "lat",
        "lon",
        height,
        upward_only=True,
    )
    keys = [slot, "_band", "_cell"]

    left, right, keys = _dealt(left, right, keys, "_mmsi", cell_rows)
    away = haversine(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon"), earth)
    once = (F.col("_band") > F.col("_home")) | (F.col("mmsi") < F.col("_mmsi"))
    return (
        left.join(right, keys)
        .where(once & (F.col("mmsi") != F.col("_mmsi")))
        .withColumn("miles", away)
        .where(F.col("miles") <= miles)
        .select(
            slot,
            F.least("mmsi", "_mmsi").alias("mmsi_a"),
            F.greatest("mmsi", "_mmsi").alias("mmsi_b"),
            "miles",
        )
    )


def forecast(positions: DataFrame, minutes: float = HORIZON_MINUTES, model: str = "wgs84") -> DataFrame:
    """Adds ``dest_lat, dest_lon``: where each vessel will be if it keeps speed and course."""
    return with_destination(positions, horizon_miles(F.col("sog"), minutes), model=model)


def forecast_moving(snapshot: DataFrame, minutes: float = HORIZON_MINUTES, model: str = "wgs84") -> DataFrame:
    """Forecast for every moving vessel of a snapshot, from its latest message."""
    latest = latest_positions(snapshot.where(F.col("sog") >= MOVING_KNOTS), keep=("sog", "cog"))
    return forecast(latest, minutes, model)


def forecast_lines(forecasts: DataFrame) -> DataFrame:
    """The two-point line from here to there."""
    here = F.struct(F.col("lat"), F.col("lon"))
    there = F.struct(F.col("dest_lat").alias("lat"), F.col("dest_lon").alias("lon"))
    return forecasts.select("mmsi", F.array(here, there).alias("points"))


def marker_rectangles(positions: DataFrame, dlat: float = MARKER_LAT, dlon: float = MARKER_LON) -> DataFrame:
    return positions.withColumns(
        {
            "south": F.col("lat") - dlat,
            "west": F.col("lon") - dlon,
            "north": F.col("lat") + dlat,
            "east": F.col("lon") + dlon,
        }
    )
