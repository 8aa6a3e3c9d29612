"""Tracks that are kept up to date while messages are appended.

``points`` holds a vessel's points of one time step in a row, in a folder for each step; ``sizes`` holds one short row for each of
those rows. An append rewrites the folders of the steps that the new messages fall into and no others. Where a step begins in the
whole track follows from the sizes, so it need not be stored, and no step after a late message has to be touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wakeline.operators.motion import order_key
from wakeline.operators.parts import with_part
from wakeline.schema import MOTION_COLUMNS, PART_SECONDS
from wakeline.sources.scratch import exists, materialise


def append_tracks(motion: DataFrame, path: str, seconds: int = PART_SECONDS) -> list[int]:
    """Adds messages to the tracks at ``path`` (made if absent) and returns the steps whose folders were replaced.

    ``seconds`` must stay the same for a table. A message that is appended twice is in the track twice. Messages without id are
    left out. The merged steps are stored first; sizes are replaced after the points they describe, so a run that ended
    between the two is mended by ``rebuild_sizes``."""
    spark = motion.sparkSession
    keys = order_key(motion)
    fields = keys + [c for c in MOTION_COLUMNS if c != "mmsi" and c not in keys and c in motion.columns]
    fresh = with_part(motion, seconds).groupBy("mmsi", "part").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("points"))
    fresh = materialise(fresh, "fresh")
    touched = sorted(r.part for r in fresh.select("part").distinct().collect())  # steps of the new messages
    if not touched:
        return []
    merged = fresh
    if exists(spark, f"{path}/points"):
        stored = spark.read.parquet(f"{path}/points").where(F.col("part").isin(touched)).select("mmsi", "part", "points")
        both = stored.unionByName(fresh).groupBy("mmsi", "part")
        merged = materialise(both.agg(F.sort_array(F.flatten(F.collect_list("points"))).alias("points")), "merged")
    _replace(merged, f"{path}/points")
    _replace(_sizes(merged), f"{path}/sizes")
    return touched


def _replace(rows: DataFrame, path: str) -> None:
    # Ranges over (step, vessel): a step with very many vessels is written by several tasks.
    ranged = rows.repartitionByRange("part", "mmsi").sortWithinPartitions("part", "mmsi")
    ranged.write.partitionBy("part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _sizes(points: DataFrame) -> DataFrame:
    return points.select("mmsi", "part", F.size("points").cast("long").alias("n"), F.array_max("points.base_dt").alias("last_dt"))


def rebuild_sizes(spark: SparkSession, path: str) -> None:
    """Writes the sizes of all stored steps anew."""
    _replace(materialise(_sizes(spark.read.parquet(f"{path}/points")), "sizes"), f"{path}/sizes")


def appended_tracks(spark: SparkSession, path: str) -> DataFrame:
    """(mmsi, part, first_idx, n_points, before_dt, points), as ``build_tracks`` gives them for all messages appended so far."""
    sizes = spark.read.parquet(f"{path}/sizes").withColumn("part", F.col("part").cast("bigint"))
    along = W.partitionBy("mmsi").orderBy("part")
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    places = sizes.select(
        "mmsi",
        "part",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("bigint").alias("first_idx"),
        F.sum("n").over(W.partitionBy("mmsi")).cast("bigint").alias("n_points"),
        F.last("last_dt", ignorenulls=True).over(earlier).alias("before_dt"),
    )
    points = spark.read.parquet(f"{path}/points").withColumn("part", F.col("part").cast("bigint"))
    joined = points.join(places, ["mmsi", "part"])
    return joined.select("mmsi", "part", "first_idx", "n_points", "before_dt", "points")
