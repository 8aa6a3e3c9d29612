"""Polygon layers from GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE = (
    "id STRING, properties STRUCT<OBJL: STRING>, "
    "geometry STRUCT<type: STRING, coordinates: STRING>"
)
_RING = "array<array<double>>"


def _layer(features: DataFrame, holes: bool) -> DataFrame:
    """A row for each polygon: a MultiPolygon gives several rows of one feature. Geometries of
    other types have no ring and are left out; ``unread`` has the lines that are no feature."""
    text, kind = F.col("geometry.coordinates"), F.col("geometry.type")
    one = F.array(F.from_json(text, f"array<{_RING}>"))
    polygons = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", F.from_json(text, f"array<array<{_RING}>>"))
    each = features.select("id", "properties", F.explode(polygons).alias("polygon"))

    def points(ring: Column) -> Column:
        return F.transform(ring, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))

    inner = F.slice("polygon", F.lit(2), F.greatest(F.size("polygon") - 1, F.lit(0)))
    return each.select(
        F.col("id").alias("feature_id"),
        F.col("properties.OBJL").alias("objl"),
        points(F.get("polygon", F.lit(0))).alias("ring"),
        *([F.transform(inner, points).alias("holes")] if holes else []),
    )


def unread(spark: SparkSession, path: str) -> DataFrame:
    """(line): the lines of a one-feature-per-line file that are not a feature with a geometry."""
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    parsed = F.from_json("line", "type STRING, geometry STRUCT<type: STRING, coordinates: STRING>")
    return lines.where((F.trim("line") != "") & parsed["geometry"]["type"].isNull())


def read_polygons(spark: SparkSession, path: str, collection: bool = False, holes: bool = False) -> DataFrame:
    """(feature_id, objl, ring): exterior rings, and with ``holes`` the array of inner rings. One feature per line by default,
    which splits over tasks; ``collection`` reads whole FeatureCollection files."""
    if collection:
        files = spark.read.schema(f"features ARRAY<STRUCT<{_as_struct(FEATURE)}>>").option("multiLine", True)
        return _layer(files.json(path).select(F.explode("features").alias("f")).select("f.*"), holes)
    return _layer(spark.read.schema(FEATURE).json(path), holes)


def _as_struct(ddl: str) -> str:
    return ddl.replace("id STRING", "id: STRING").replace("properties STRUCT", "properties: STRUCT").replace(
        "geometry STRUCT", "geometry: STRUCT"
    )


def write_polygons(layer: DataFrame, path: str) -> None:
    """One GeoJSON feature per line from (feature_id, objl, ring)."""
    ring = F.transform("ring", lambda p: F.array(p["lon"], p["lat"]))
    layer.select(
        F.lit("Feature").alias("type"),
        F.col("feature_id").alias("id"),
        F.struct(F.col("objl").alias("OBJL")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    ).write.json(path)
