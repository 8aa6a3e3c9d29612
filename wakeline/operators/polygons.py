"""Polygon layer: classes and rings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.schema import POLYGON_CLASSES


def with_polygon_class(layer: DataFrame) -> DataFrame:
    """Adds ``polygon_class``; features of any other kind are dropped."""
    chain = F.when(F.lit(False), F.lit(None))
    for code, name in POLYGON_CLASSES.items():
        chain = chain.when(F.col("objl") == code, name)
    return layer.where(F.col("objl").isin([*POLYGON_CLASSES])).withColumn("polygon_class", chain)


def lat_lon_rings(layer: DataFrame) -> DataFrame:
    """Exterior rings as (lat, lon) points."""
    swapped = F.transform("ring", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))
    return layer.withColumn("ring", swapped)


def ring_points(layer: DataFrame) -> DataFrame:
    """One row per vertex with its place ``vtx``."""
    others = [c for c in layer.columns if c != "ring"]
    return layer.select(*others, F.posexplode("ring").alias("vtx", "_p")).select(*others, "vtx", "_p.*")
