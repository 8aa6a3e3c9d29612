"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"

_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that ``spark.checkpoint.dir`` names.

    A session without that setting uses its warehouse, if driver and executors share that as well: on a cluster a
    warehouse on a local disk is refused.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        root = spark.conf.get(WAREHOUSE)
        local_disk = root.startswith("file:") or "://" not in root
        if local_disk and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that driver and executors share")
    path = f"{root.rstrip('/')}/wakeline/{label}-{uuid4().hex}"
    _made.append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` once and returns a scan of it: later consumers read columns from the
    table instead of recomputing, and a lost executor does not restart the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many paths this process has stored and not released: what comes later can be released from here."""
    return len(_made)


def release(spark: SparkSession, since: int = 0, keep_last: bool = False) -> int:
    """Deletes what this process stored below ``scratch_path`` after the ``mark`` ``since`` (all by default), but for the newest path
    with ``keep_last``, and returns how many paths went.

    Frames that still read them fail afterwards: call it when the results are written.
    """
    kept = _made[-1:] if keep_last else []
    gone = 0
    for name in _made[since : len(_made) - len(kept)]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    del _made[since : len(_made) - len(kept)]
    return gone


def exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
