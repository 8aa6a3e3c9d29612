"""Which polygons a position lies in.

A polygon is cut into rows of a grid; of each row the edges that cross it decide which cells lie inside, which on the
border and which outside. A position meets the cells of its own place in an equi-join: in an inner cell it is inside
without a test, in a border cell the crossings of a ray to the east are counted against the edges of that row. Cells carry what
the result keeps of their polygon, so a found pair is not joined again; where positions and polygons are dense, the pairs
that meet grow with the product of both, and the tasks with the pairs.

A position on an edge or a vertex is inside. Rings count by even and odd, so a hole is outside and a hole's edge is inside.
A ring that is not closed is closed. Polygons do not cross the 180th meridian.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.schema import BROADCAST_ROWS, CELL_ROWS
from wakeline.sources.scratch import materialise

#: Height and width of a cell in degrees.
CELL_DEGREES = 0.05
#: Rows with no more edges hold them in columns, which compiled code compares; others in an array. Four make a method of about 7,100
#: bytes, three of 5,600; the JVM compiles none above 8,000, and a wider result adds to it.
FLAT_EDGES = 3
#: Pairs of a position and a cell of its place that one task compares, about.
TASK_PAIRS = 4_000_000
#: Polygons that one task cuts into cells.
TASK_POLYGONS = 5_000
#: A side that is split over tasks is dealt out anew when its rows meet more than so many of the other on average.
DENSE = 4


def ring_edges(layer: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(feature, keep..., y1, x1, y2, x2): the edges of the exterior ring and of the ``holes``, if the layer has them."""
    rings = F.array(F.col("ring"))
    if "holes" in layer.columns:
        rings = F.concat(rings, F.coalesce("holes", F.array().cast(layer.schema["holes"].dataType)))
    each = layer.select("feature", *keep, F.explode(rings).alias("r")).where("size(r) > 0")
    ends = F.concat(F.slice("r", F.lit(2), F.size("r") - 1), F.slice("r", F.lit(1), F.lit(1)))
    edges = each.select("feature", *keep, F.explode(F.arrays_zip(F.col("r").alias("a"), ends.alias("b"))).alias("e"))
    return edges.select(
        "feature",
        *keep,
        F.col("e.a.lat").alias("y1"),
        F.col("e.a.lon").alias("x1"),
        F.col("e.b.lat").alias("y2"),
        F.col("e.b.lon").alias("x2"),
    )


def _is_on(e: Column, y: Column, x: Column) -> Column:
    cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return (
        (cross == 0)
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
    )


def _is_crossed(e: Column, y: Column, x: Column) -> Column:
    """Whether a ray from the point to the east crosses the edge; of its ends the lower belongs to it."""
    return ((e["y1"] > y) != (e["y2"] > y)) & (x < F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"])


def contains(edges: Column, y: Column, x: Column) -> Column:
    """Whether the polygon of an array of edges holds the point, its border included."""
    crossed = F.size(F.filter(edges, lambda e: _is_crossed(e, y, x))) % 2 == 1
    return F.exists(edges, lambda e: _is_on(e, y, x)) | crossed


def cell_cover(layer: DataFrame, degrees: float = CELL_DEGREES, keep: tuple[str, ...] = ()) -> DataFrame:
    """(feature, row, cell, edges, keep...): the grid cells that each polygon touches. ``edges`` are the row's edges where the border
    may run through the cell, and null in cells that lie inside."""

    def number(value: Column) -> Column:
        return F.floor(value / degrees).cast("int")

    named = layer.select(*layer.columns, F.struct(F.lit(0).alias("_"), *keep).alias("kept"))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = ring_edges(named, ("kept",)).withColumn("row", F.explode(F.sequence(number(low), number(high))))
    # The part of the edge in the row, widened a little: rounding must not leave a border cell out.
    slack = degrees * 1e-9
    bottom, top = (F.col("row") * degrees - slack), ((F.col("row") + 1) * degrees + slack)
    run, rise = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def at(y: Column) -> Column:
        return F.when(rise == 0, F.col("x1")).otherwise(F.col("x1") + run * (y - F.col("y1")) / rise)

    left, right = at(F.greatest(low, bottom)), at(F.least(high, top))
    flat = rise == 0
    first = F.when(flat, F.least("x1", "x2")).otherwise(F.least(left, right)) - slack
    last = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(left, right)) + slack
    marked = rows.select(
        "feature",
        "row",
        "kept",
        F.struct("y1", "x1", "y2", "x2").alias("e"),
        number(first).alias("from"),
        number(last).alias("to"),
    )
    by_row = marked.groupBy("feature", "row").agg(
        F.collect_list("e").alias("edges"),
        F.array_distinct(F.flatten(F.collect_list(F.sequence("from", "to")))).alias("border"),
        F.min("from").alias("from"),
        F.max("to").alias("to"),
        F.first("kept").alias("kept"),
    )
    each = by_row.withColumn("cell", F.explode(F.sequence("from", "to")))
    border = F.array_contains("border", F.col("cell"))
    # No edge runs through the others: one point decides for the whole cell.
    middle = contains(F.col("edges"), (F.col("row") + 0.5) * degrees, (F.col("cell") + 0.5) * degrees)
    held = each.where(border | middle)
    return held.select("feature", "row", "cell", F.when(border, F.col("edges")).alias("edges"), *(F.col("kept")[c].alias(c) for c in keep))


def _flat(cover: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """(_row, _cell, _edges, _n, _y1_0, _x1_0, ..., _keep_0, ...): up to ``FLAT_EDGES`` edges in columns, more of them in the array;
    ``_n`` is their number, null in inner cells. No name is one of a position's."""
    few = F.size("edges") <= FLAT_EDGES
    ends = ("y1", "x1", "y2", "x2")
    flat = [F.when(few, F.get("edges", F.lit(i)))[c].alias(f"_{c}_{i}") for i in range(FLAT_EDGES) for c in ends]
    return cover.select(
        F.col("row").alias("_row"),
        F.col("cell").alias("_cell"),
        F.when(~few, F.col("edges")).alias("_edges"),
        F.when(F.col("edges").isNotNull(), F.size("edges")).alias("_n"),
        *flat,
        *(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)),
    )


def _holds(y: Column, x: Column) -> Column:
    """``contains`` for the edges in the columns of ``_flat``; an absent edge is neither crossed nor touched."""
    edges = [{c: F.col(f"_{c}_{i}") for c in ("y1", "x1", "y2", "x2")} for i in range(FLAT_EDGES)]
    crossed = sum((F.when(_is_crossed(e, y, x), 1).otherwise(0) for e in edges), F.lit(0)) % 2 == 1
    touched = F.lit(False)
    for e in edges:
        touched = touched | F.coalesce(_is_on(e, y, x), F.lit(False))
    return crossed | touched


def _meet(given: DataFrame, cover: DataFrame) -> DataFrame:
    """Positions and the cells of their place: the smaller side is broadcast, if it has no more than ``BROADCAST_ROWS``, and the other
    is spread evenly where it meets many; else both are shuffled by cell, and the positions of a crowded cell dealt over shares."""
    keys = ["_row", "_cell"]
    places = materialise(given.groupBy(*keys).agg(F.count(F.lit(1)).alias("_p")), "places")
    met = cover.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).join(places, keys)
    pairs = met.agg(F.sum(F.col("_p").cast("double") * F.col("_c"))).first()[0] or 0.0
    sizes = given.count(), cover.count()
    tasks = int(max(pairs / TASK_PAIRS, sum(sizes) / (TASK_PAIRS / DENSE))) + 1
    if min(sizes) <= BROADCAST_ROWS:
        few, many = (given, cover) if sizes[0] <= sizes[1] else (cover, given)
        if pairs > DENSE * max(sizes):
            many = many.repartition(tasks)
        return many.join(F.broadcast(few), keys)
    crowded = materialise(places.where(F.col("_p") > CELL_ROWS).select(*keys, F.ceil(F.col("_p") / CELL_ROWS).cast("int").alias("_shares")), "crowded-cells")
    if held := crowded.count():
        shares = F.broadcast(crowded) if held <= BROADCAST_ROWS else crowded
        count = F.coalesce("_shares", F.lit(1))
        share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), count).cast("int")
        given = given.join(shares, keys, "left").withColumn("_share", share).drop("_shares")
        visited = F.explode(F.sequence(F.lit(0), count - 1))
        cover = cover.join(shares, keys, "left").withColumn("_share", visited).drop("_shares")
        keys = [*keys, "_share"]
    # The positions of a cell are the side that is held, cells pass by.
    return cover.repartition(tasks, *keys).join(given.repartition(tasks, *keys), keys)


def in_polygons(
    positions: DataFrame, layer: DataFrame, degrees: float = CELL_DEGREES, keep: tuple[str, ...] = ("feature_id", "polygon_class")
) -> DataFrame:
    """The columns of ``positions`` and the ``keep`` columns of every polygon of ``layer`` (ring, and holes if there are any) that
    holds the position; a position outside of all polygons, or without coordinates, has no row.

    Positions and cells are stored and counted, with the pairs that meet: see ``_meet``."""
    named = materialise(layer.withColumn("feature", F.monotonically_increasing_id()), "layer")
    # Dealt out by feature, which the grouping of edges by row needs as well: a layer of one short file is cut by many tasks.
    spread = named.repartition(named.count() // TASK_POLYGONS + 1, "feature")
    cover = materialise(_flat(cell_cover(spread, degrees, keep), keep), "cover")
    row, cell = (F.floor(F.col(c) / degrees).cast("int") for c in ("lat", "lon"))
    placed = positions.where("lat IS NOT NULL AND lon IS NOT NULL").withColumns({"_row": row, "_cell": cell})
    given = materialise(placed, "positions")
    lat, lon = F.col("lat"), F.col("lon")
    kept = [F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)]
    flat = cover.where(F.col("_n").isNull() | (F.col("_n") <= FLAT_EDGES)).drop("_edges")
    found = _meet(given, flat).where(F.col("_n").isNull() | _holds(lat, lon)).select(*positions.columns, *kept)
    long = cover.where(F.col("_n") > FLAT_EDGES).select("_row", "_cell", "_edges", *(f"_keep_{i}" for i in range(len(keep))))
    if long.isEmpty():
        return found
    return found.unionByName(_meet(given, long).where(contains(F.col("_edges"), lat, lon)).select(*positions.columns, *kept))
