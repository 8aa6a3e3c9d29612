import json
import random

import pytest

from wakeline.operators import zones
from wakeline.operators.zones import cell_cover, in_polygons
from wakeline.sources.layers import read_polygons

LAYER = "feature_id int, polygon_class string, ring array<struct<lon: double, lat: double>>, holes array<array<struct<lon: double, lat: double>>>"


def box(y, x, h, w):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def shapes():
    rng = random.Random(4)
    out = [
        (1, "lane", box(48.0, -123.0, 0.5, 0.5), [box(48.125, -122.875, 0.25, 0.25)]),
        (2, "lane", [(-122.0, 48.0), (-121.0, 48.0), (-121.5, 48.25), (-121.0, 48.5), (-122.0, 48.5)], None),  # concave, not closed
        (3, "area", box(48.01, -122.99, 0.003, 0.003), []),  # inside one cell
        (4, "area", [(-123.0, 48.0), (-122.0, 48.0), (-123.0, 48.0)], []),  # no area
        (5, "area", [], []),
        (6, "area", box(-1.0, -1.0, 2.0, 2.0), [box(-0.5, -0.5, 0.25, 0.25), box(0.25, 0.25, 0.5, 0.25)]),
    ]
    for i in range(12):
        y, x = rng.uniform(47, 49), rng.uniform(-124, -122)
        out.append((10 + i, "lane", [(x + rng.uniform(-0.4, 0.4), y + rng.uniform(-0.4, 0.4)) for _ in range(rng.randint(3, 9))], []))
    return out


def points():
    rng = random.Random(5)
    out = [(i, rng.uniform(46.5, 49.5), rng.uniform(-124.5, -120.5)) for i in range(600)]
    fixed = [(48.0, -123.0), (48.25, -123.0), (48.5, -122.5), (48.125, -122.875), (48.2, -122.875), (48.25, -122.75), (48.25, -121.5), (48.25, -121.4), (48.25, -121.6),
             (48.0, -122.5), (48.0, -122.0), (0.0, 0.0), (-0.4, -0.4), (0.3, 0.3), (-1.0, -1.0), (1.0, 0.5), (48.0115, -122.9885), (48.05, -122.95), (48.1, -122.9)]
    out += [(1000 + i, y, x) for i, (y, x) in enumerate(fixed)]
    for feature, _, ring, _ in shapes():
        out += [(2000 + 50 * feature + k, p[1], p[0]) for k, p in enumerate(ring)]
    return out + [(9000, None, 1.0), (9001, 48.2, None)]


def holds(ring, holes, y, x):
    crossed = False
    for r in [ring, *(holes or [])]:
        for (x1, y1), (x2, y2) in zip(r, [*r[1:], r[0]] if r else []):
            on = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0
            if on and min(y1, y2) <= y <= max(y1, y2) and min(x1, x2) <= x <= max(x1, x2):
                return True
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                crossed = not crossed
    return crossed


@pytest.mark.parametrize("broadcast", [1_000_000, -1])
@pytest.mark.parametrize("degrees", [0.05, 0.3, 5.0])
def test_polygons_of_positions(spark, rows, monkeypatch, degrees, broadcast):
    monkeypatch.setattr(zones, "BROADCAST_ROWS", broadcast)
    layer = spark.createDataFrame(shapes(), LAYER)
    given = spark.createDataFrame(points(), "mmsi int, lat double, lon double")
    found = rows(in_polygons(given, layer, degrees), "mmsi", "feature_id")
    want = [(m, f) for m, y, x in points() if None not in (y, x) for f, _, ring, holes in shapes() if holds(ring, holes, y, x)]
    assert found == sorted(want, key=repr) and len(want) > 200
    assert in_polygons(given, layer.limit(0)).count() == in_polygons(given.limit(0), layer).count() == 0


def test_only_border_cells_hold_edges(spark):
    cover = cell_cover(spark.createDataFrame([(7, box(10.05, 20.05, 1.0, 1.0))], "feature long, ring array<struct<lon: double, lat: double>>"), 0.1)
    counts = {bool(r.inner): r["count"] for r in cover.selectExpr("edges IS NULL AS inner").groupBy("inner").count().collect()}
    assert counts == {True: 81, False: 40}
    assert cover.groupBy("row", "cell").count().where("count > 1").count() == 0


def test_holes_of_a_layer(spark, tmp_path, rows):
    rings = [box(48.0, -123.0, 0.5, 0.5), box(48.125, -122.875, 0.25, 0.25)]
    coordinates = [[list(p) for p in r] for r in rings]
    kinds = {"Polygon": coordinates, "MultiPolygon": [coordinates, [coordinates[0]]]}
    path = tmp_path / "l.json"
    path.write_text("\n".join(json.dumps({"type": "Feature", "id": k, "properties": {"OBJL": "148"}, "geometry": {"type": k, "coordinates": c}}) for k, c in kinds.items()))
    layer = read_polygons(spark, str(path), holes=True)
    assert rows(layer.selectExpr("feature_id", "size(ring)", "size(holes)")) == [("MultiPolygon", 5, 0), ("MultiPolygon", 5, 1), ("Polygon", 5, 1)]
    at = spark.createDataFrame([(1, 48.25, -122.75), (2, 48.05, -122.95)], "mmsi int, lat double, lon double")
    assert rows(in_polygons(at, layer, keep=("feature_id",)), "mmsi", "feature_id") == [
        (1, "MultiPolygon"), (2, "MultiPolygon"), (2, "MultiPolygon"), (2, "Polygon")
    ]


def test_a_dense_layer_is_spread_over_tasks(spark, rows, monkeypatch):
    """Every position meets every polygon: the pairs, not the rows, set the number of tasks, and no pair is shuffled afterwards."""
    layer = spark.createDataFrame([(i, "lane", box(48.0 + i / 10000, -123.0, 0.3, 0.3), []) for i in range(40)], LAYER)
    given = spark.createDataFrame([(i, 48.1 + i / 1000, -122.9) for i in range(60)], "mmsi int, lat double, lon double")
    want = rows(in_polygons(given, layer), "mmsi", "feature_id")
    assert len(want) == 40 * 60
    monkeypatch.setattr(zones, "TASK_PAIRS", 100)
    monkeypatch.setattr(zones, "DENSE", 1)
    for most, held in ((1_000_000, 2_000), (-1, 7)):
        monkeypatch.setattr(zones, "BROADCAST_ROWS", most)
        monkeypatch.setattr(zones, "CELL_ROWS", held)
        found = in_polygons(given, layer)
        assert rows(found, "mmsi", "feature_id") == want
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert " feature#" not in plan  # the kept columns come with the cells
        # 2,400 pairs by a hundred a task
        assert "REPARTITION_BY_NUM" in plan and found.rdd.getNumPartitions() >= 24
