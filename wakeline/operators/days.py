"""Speed statistics from state that is kept by day and merges.

Speeds come in steps of 0.1 knot, so the exact state of a vessel's day is its histogram of at most about a thousand rows;
any set of days gives the exact quantiles by adding histograms. For speeds without steps there are quantile sketches: a
day is one binary value of bounded size, sketches of days merge, and a quantile is off by a bounded share of ranks.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.tracks import statistics_of_counts
from wakeline.schema import IN_MOTION_KNOTS, QUINTILES

#: Size parameter of a sketch. A quantile of a sketch with it, merged or not, is one whose rank is off by less than
#: ``SKETCH_ERROR`` of all moving points in 99 of 100 cases.
SKETCH_K = 200
SKETCH_ERROR = 0.0165


def daily_speed_counts(points: DataFrame) -> DataFrame:
    """(day, mmsi, sog, n): the histogram of each vessel's UTC day. Points without time have the day null."""
    known = points.where(F.col("sog").isNotNull())
    return known.groupBy(F.to_date("base_dt").alias("day"), "mmsi", "sog").agg(F.count(F.lit(1)).alias("n"))


def write_speed_days(points: DataFrame, path: str) -> None:
    """Stores the histograms of the days that ``points`` holds, whole days each, in ``day=`` folders. Days that are stored
    already are replaced, all others stay as they are."""
    daily_speed_counts(points).write.partitionBy("day").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def speed_statistics_of_days(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None, in_motion: float = IN_MOTION_KNOTS
) -> DataFrame:
    """``speed_statistics`` of the stored days from ``first`` to ``last`` (all without bounds): no message is read."""
    days = spark.read.parquet(path)
    if first is not None:
        days = days.where(F.col("day") >= F.lit(first))
    if last is not None:
        days = days.where(F.col("day") <= F.lit(last))
    return statistics_of_counts(days.drop("day"), in_motion)


def daily_speed_sketches(points: DataFrame, in_motion: float = IN_MOTION_KNOTS, k: int = SKETCH_K) -> DataFrame:
    """(day, mmsi, max_sog, sketch): a quantile sketch of the moving speeds of each vessel's UTC day, null if it has none."""
    known = points.where(F.col("sog").isNotNull()).withColumn("speed", F.col("sog").cast("double"))
    moving = F.when(F.col("speed") >= in_motion, F.col("speed"))
    by_day = known.groupBy(F.to_date("base_dt").alias("day"), "mmsi")
    found = by_day.agg(F.max("speed").alias("max_sog"), F.count(moving).alias("n"), F.kll_sketch_agg_double(moving, k).alias("sketch"))
    return found.select("day", "mmsi", "max_sog", F.when(F.col("n") > 0, F.col("sketch")).alias("sketch"))


def statistics_of_sketches(daily: DataFrame) -> DataFrame:
    """(mmsi, max_sog, median_sog, q20..q80) of merged days, each quantile an observed speed within ``SKETCH_ERROR`` of its rank."""
    merged = daily.groupBy("mmsi").agg(
        F.max("max_sog").alias("max_sog"), F.kll_merge_agg_double("sketch").alias("sketch"), F.count("sketch").alias("n")
    )
    some = merged.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))

    def quantile(q: float) -> Column:
        return F.when(F.col("sketch").isNotNull(), F.kll_sketch_get_quantile_double("sketch", F.lit(q)))

    cuts = [quantile(q).alias(f"q{int(q * 100)}") for q in QUINTILES]
    return some.select("mmsi", "max_sog", quantile(0.5).alias("median_sog"), *cuts)
