"""Parquet scans, sinks and table registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.timefn import epoch_seconds
from wakeline.operators.motion import order_key
from wakeline.operators.vessels import group_memberships, upsert
from wakeline.schema import BASE_SECONDS, LOCAL_SECONDS
from wakeline.sources.scratch import materialise


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_day(spark: SparkSession, root: str, year: int, month: int, day: int) -> DataFrame:
    """One day directory of a day-partitioned table, chosen by partition pruning."""
    return spark.read.parquet(root).where(
        (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
    )


def write_if_absent(df: DataFrame, path: str) -> None:
    """Writes, or leaves an existing table as it is."""
    df.write.mode("ignore").parquet(path)


def write_by_time(df: DataFrame, path: str) -> None:
    """Files that follow each other in time, with the seconds stored for skipping. The range
    key ends in the tie-break columns: even one busy second is cut."""
    ranges = [*order_key(df), "mmsi"]
    stamped = df.withColumn(BASE_SECONDS, epoch_seconds(F.col("base_dt")))
    stamped.repartitionByRange(*ranges).sortWithinPartitions(*ranges).write.mode("ignore").parquet(path)


def write_by_day(df: DataFrame, path: str) -> None:
    """Day-partitioned layout; fails if the table exists.

    Ranges over (day, time) rather than one task per day: a task holds one stretch of
    time, so days of any size are written in parallel and most tasks open one or two
    files."""
    ranges = ["year", "month", "day", *order_key(df), "mmsi"]
    stamped = df.withColumns(
        {
            BASE_SECONDS: epoch_seconds(F.col("base_dt")),
            LOCAL_SECONDS: epoch_seconds(F.col("localtime")),
        }
    )
    (
        stamped.repartitionByRange(*ranges)
        .sortWithinPartitions(*ranges)
        .write.partitionBy("year", "month", "day")
        .parquet(path)
    )


def write_groups(tracks: DataFrame, meta: DataFrame, period: str, path: str) -> None:
    """Tracks of every vessel group in one job, in ``period=/vessel_group=`` folders. A
    vessel in two groups is in both folders; one in no group is left out. A run replaces its period whole,
    so a group that has no rows any more has no tracks either; other periods stay."""
    memberships = group_memberships(meta)
    (
        tracks.join(memberships, "mmsi")
        # Rebalancing splits a group that holds a large share of the tracks.
        .hint("rebalance", "vessel_group")
        .write.partitionBy("vessel_group")
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .parquet(f"{path}/period={period}")
    )


def read_group(spark: SparkSession, path: str, vessel_group: str = "cargo", period: str = "3m") -> DataFrame:
    """Tracks of one group and period; reads that folder only."""
    return spark.read.parquet(path).where(
        (F.col("period") == period) & (F.col("vessel_group") == vessel_group)
    )


def _place(spark: SparkSession, path: str) -> str:
    """The full form of a path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Makes a (partitioned) Parquet folder known to the catalog under ``name``; a name that stands for
    another folder is an error."""
    if spark.catalog.tableExists(name):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
        if _place(spark, described.data_type) != _place(spark, path):
            raise ValueError(f"{name} is already the name of {described.data_type}")
    else:
        spark.catalog.createTable(name, path=path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def upsert_stored(
    spark: SparkSession, path: str, fresh: DataFrame, version: list[str], key: str = "doc_id", buckets: int = 64
) -> None:
    """Brings new versions of documents into the table at ``path``, which is made if it is absent.

    Documents lie in folders by a hash of their key. Only the folders that ``fresh`` touches are read,
    merged (the last version of each document stays) and replaced; ``buckets`` must stay the same for a
    table. The merged rows are stored before they replace what they were read from.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    merged = upsert(fresh, version, key).withColumn("bucket", bucket)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        touched = [r.bucket for r in merged.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
        stored = spark.read.parquet(path).where(F.col("bucket").isin(touched))
        both = stored.drop("bucket").unionByName(merged.drop("bucket"))
        merged = materialise(upsert(both, version, key).withColumn("bucket", bucket), "upsert")
    writer = merged.repartition("bucket").write.partitionBy("bucket").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
