"""Streaming forms: latest position per vessel and slot, last-hour activity per vessel.

Event time is the UTC instant of ``base_dt`` (the watermark needs instants). State per
vessel and window is one row of fixed size, so a busy vessel costs no more than a quiet
one, and the partial aggregation runs before the shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.timefn import instant, ntz, wall_clock
from wakeline.operators.motion import order_key
from wakeline.schema import HOUR_SECONDS, MINUTE_SECONDS
from wakeline.sources.scratch import scratch_path
from wakeline.sources.tables import write_by_time

DELAY = "10 minutes"
_REPORTS = "spark.sql.streaming.numRecentProgressUpdates"
_MOST_REPORTS = 1_000_000


def with_event_time(messages: DataFrame, delay: str = DELAY) -> DataFrame:
    return messages.withColumn("event_time", instant(F.col("base_dt"))).withWatermark("event_time", delay)


def latest_by_slot(messages: DataFrame, slot: str = "1 minute", delay: str = DELAY) -> DataFrame:
    """(slot_start, mmsi, lat, lon): the last position in each closed slot."""
    last = F.max_by(F.struct("lat", "lon"), F.struct(*order_key(messages)))
    return (
        with_event_time(messages, delay)
        .groupBy(F.window("event_time", slot).alias("slot"), "mmsi")
        .agg(last.alias("_last"))
        .select(wall_clock(F.col("slot.start")).alias("slot_start"), "mmsi", "_last.*")
    )


def last_hour_activity(
    messages: DataFrame,
    width: int = HOUR_SECONDS,
    slide: int = MINUTE_SECONDS,
    delay: str = DELAY,
) -> DataFrame:
    """(window_end, mmsi, n_points, first_dt, last_dt) for every closed sliding window.

    Messages are first counted per vessel and slide step; only those counts are copied
    into the ``width / slide`` windows they fall in."""
    if width % slide:
        raise ValueError("width must be a multiple of slide")
    steps = (
        with_event_time(messages, delay)
        .groupBy(F.window("event_time", f"{slide} seconds").alias("step"), "mmsi")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("base_dt").alias("first_dt"),
            F.max("base_dt").alias("last_dt"),
        )
    )
    spans = F.window(F.window_time("step"), f"{width} seconds", f"{slide} seconds")
    return (
        steps.groupBy(spans.alias("span"), "mmsi")
        .agg(
            F.sum("n").alias("n_points"),
            F.min("first_dt").alias("first_dt"),
            F.max("last_dt").alias("last_dt"),
        )
        .select(wall_clock(F.col("span.end")).alias("window_end"), "mmsi", "n_points", "first_dt", "last_dt")
    )


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Runs a stream over what its source holds now, appends the closed windows to a
    Parquet table in the shared folder and returns a scan of it."""
    return _run(stream, label)[0]


class LateRows(RuntimeError):
    """A replay dropped messages that came after their window had closed."""


def run_to_end(stream: DataFrame, batch: DataFrame, end: Column, label: str) -> DataFrame:
    """Closed windows from the stream and the ones that are still open from ``batch``, the same
    aggregation over the same messages at rest. ``end`` is a window's end as UTC wall clock: what ends by the
    stream's last watermark is closed. A stream whose messages come in order of time (``replay``) drops none; if one
    came too late all the same, the result would not be whole and ``LateRows`` says so."""
    closed, watermark, dropped = _run(stream, label)
    if dropped:
        raise LateRows(f"{dropped} aggregated rows came too late: replay the messages in order of time")
    return closed.unionByName(batch if watermark is None else batch.where(end > ntz(watermark)))


def replay(messages: DataFrame, label: str, files_per_batch: int = 1000) -> tuple[DataFrame, DataFrame]:
    """``messages`` as a stream in order of time, and the same rows at rest.

    They are laid out once in files that follow each other in time (``write_by_time``). A file source takes files by their time
    of change, which says nothing here: it is set in the order of the files' names, one second apart. Stores that keep no time
    of change need writers that add files in order."""
    spark = messages.sparkSession
    place = scratch_path(spark, label)
    write_by_time(messages, place)
    folder = spark._jvm.org.apache.hadoop.fs.Path(place)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in store.listStatus(folder)), key=lambda p: p.getName())
    for number, path in enumerate(files):
        store.setTimes(path, number * 1000, -1)
    still = spark.read.parquet(place)
    live = spark.readStream.schema(still.schema).option("maxFilesPerTrigger", files_per_batch).parquet(place)
    return live, still


def _run(stream: DataFrame, label: str) -> tuple[DataFrame, datetime | None, int]:
    """A scan of the closed windows, the last watermark, and how many aggregated rows were dropped as late."""
    spark = stream.sparkSession
    kept = spark.conf.get(_REPORTS, None)
    # Every batch must be reported: its late rows count.
    spark.conf.set(_REPORTS, str(_MOST_REPORTS))
    try:
        return _finished(stream, label)
    finally:
        if kept is None:
            spark.conf.unset(_REPORTS)
        else:
            spark.conf.set(_REPORTS, kept)


def _finished(stream: DataFrame, label: str) -> tuple[DataFrame, datetime | None, int]:
    spark = stream.sparkSession
    out = scratch_path(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", out + "-state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = query.recentProgress
    marks = [p["eventTime"]["watermark"] for p in progress if "watermark" in p["eventTime"]]
    watermark = datetime.fromisoformat(max(marks)).replace(tzinfo=None) if marks else None
    dropped = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    return spark.read.schema(stream.schema).parquet(out), watermark, dropped
