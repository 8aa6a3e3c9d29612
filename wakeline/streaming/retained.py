"""The last-hour track of each vessel as arbitrary state over a stream.

The state of a vessel is what a series with retention keeps: the points of the hour before its newest message, in
one list for each ten minutes that have any. A message that is older than that when it comes is left out, and a newer one
drops the steps that fall behind, so the result does not depend on the order of messages, files or batches and needs
no watermark; the state of a vessel never holds more than an hour and a step however long the stream runs.

The track is read from the state itself (``retained_points``), when somebody asks, instead of being sent again with each batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wakeline.functions.timefn import EPOCH, from_epoch_micros, micros_between
from wakeline.schema import RETENTION_SECONDS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Time (microseconds), tie-break, position and speed.
_POINT = "at: bigint, tie: bigint, lat: double, lon: double, sog: double"
#: Microseconds of one list.
_STEP = 600 * 1_000_000


class RetainedPoints(StatefulProcessor):
    """Keeps the points of the ``seconds`` before a vessel's newest one, in steps; gives the number that each batch left."""

    def __init__(self, seconds: int = RETENTION_SECONDS) -> None:
        self.span = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "at long")
        self.track = handle.getMapState("track", "step long", f"points array<struct<{_POINT}>>")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timer: Any) -> Iterator[pd.DataFrame]:
        newest = self.newest.get()[0] if self.newest.exists() else None
        before = newest
        fresh: dict[int, list[tuple]] = {}
        for batch in rows:
            newest = max([int(batch["at"].max()), *([] if newest is None else [newest])])
            # Whatever falls behind within the batch goes at once: no more than the retained time is held.
            kept = batch[batch["at"] > newest - self.span]
            numbers = (kept[c].tolist() for c in ("at", "tie", "lat", "lon", "sog"))
            for point in zip(*numbers):
                fresh.setdefault(point[0] // _STEP, []).append(point)
            fresh = {step: p for step, p in fresh.items() if (step + 1) * _STEP > newest - self.span}
        floor = newest - self.span
        for step, points in fresh.items():
            old = self.track.getValue((step,))[0] if self.track.containsKey((step,)) else []
            self.track.updateValue((step,), ([*map(tuple, old), *points],))
        if newest != before:
            self.newest.update((newest,))
            for (step,) in [k for k in self.track.keys() if (k[0] + 1) * _STEP <= floor]:
                self.track.removeKey((step,))
        steps = [len(v[0]) for _, v in self.track.iterator()]
        yield pd.DataFrame({"mmsi": [key[0]], "n_steps": [len(steps)], "n_points": [sum(steps)]})

    def close(self) -> None:
        pass


def retained_track(messages: DataFrame, seconds: int = RETENTION_SECONDS) -> DataFrame:
    """(mmsi, n_steps, n_points) of each vessel that a batch of the stream ``messages`` touches: how much its state holds.

    Messages without id, time or position take no part."""
    known = messages.where("mmsi IS NOT NULL AND base_dt IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
    tie = F.col("seq") if "seq" in messages.columns else F.lit(0)
    points = known.select(
        "mmsi",
        micros_between(F.col("base_dt"), F.expr(EPOCH)).alias("at"),
        tie.cast("long").alias("tie"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        F.col("sog").cast("double").alias("sog"),
    )
    return points.groupBy("mmsi").transformWithStateInPandas(
        RetainedPoints(seconds), "mmsi int, n_steps int, n_points long", "update", "none"
    )


def run_retained(stream: DataFrame, place: str) -> None:
    """Runs ``retained_track`` over what its source holds now; the state stays at ``place``, and a later run goes on from there."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        query = (
            stream.writeStream.format("noop").outputMode("update").option("checkpointLocation", place).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def retained_points(spark: SparkSession, place: str, seconds: int = RETENTION_SECONDS) -> DataFrame:
    """(mmsi, idx, base_dt, lat, lon, sog): the track of each vessel that the state at ``place`` holds, in time order from idx 0."""

    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("stateVarName", name).load(place)

    newest = state("newest").select(F.col("key.mmsi").alias("mmsi"), F.col("value.at").alias("newest"))
    steps = state("track").select(F.col("key.mmsi").alias("mmsi"), F.inline("user_map_value.points"))
    points = steps.join(newest, "mmsi").where(F.col("at") > F.col("newest") - seconds * 1_000_000)
    place_in_track = F.row_number().over(Window.partitionBy("mmsi").orderBy("at", "tie")) - 1
    return points.select(
        "mmsi",
        place_in_track.alias("idx"),
        from_epoch_micros(F.col("at")).alias("base_dt"),
        "lat",
        "lon",
        F.when(~F.isnan("sog"), F.col("sog")).alias("sog"),
    )
