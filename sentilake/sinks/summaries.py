"""Snapshot, hourly history and warehouse rows.

Invalid or empty summaries write nothing, as do summaries without contributors.
"""

from datetime import datetime

from pyspark.sql import DataFrame, Observation, functions as F

from sentilake.functions.keys import hour_key
from sentilake.operators.summaries import latest_per_hour, to_warehouse_shape, valid_counted
from sentilake.session import child_names, materialize, one_task_per_key, remove


def _stamped(summary: DataFrame, now: datetime, updated_col: str, counts: Observation | None = None) -> DataFrame:
    stamp = F.lit(now).cast("timestamp")
    return valid_counted(summary, counts).withColumns({"timestamp": stamp, updated_col: stamp})


def write_current(summary: DataFrame, path: str, now: datetime) -> bool:
    """Write a new version of the current snapshot; tells whether there was one to write.

    The summary is computed once. Versions are numbered as they are written, whatever
    ``now`` is, and readers take the last one: they see the old version until the new one
    is complete. The version before stays for readers at work, older ones are removed.
    """
    row = materialize(_stamped(summary, now, "updatedAt").coalesce(1), "snapshot")
    if row.isEmpty():
        return False
    spark = summary.sparkSession
    versions = sorted(n for n in child_names(spark, path) if n.startswith("version="))
    last = int(versions[-1].partition("=")[2]) if versions else 0
    row.write.parquet(f"{path}/version={last + 1:020d}")
    for old in versions[:-1]:
        remove(spark, f"{path}/{old}")
    return True


def upsert_history(summary: DataFrame, path: str, now: datetime | None = None) -> int:
    """Write history rows by hour; a later write of an hour replaces the earlier one.

    With ``now`` every row belongs to that hour. Without it the rows bring their own
    ``hour_key``, ``timestamp`` and ``updatedAt``, and the last one of an hour is kept.
    Returns how many invalid rows were left out, counted while the others are written.
    """
    counts = Observation()
    if now is not None:
        rows = _stamped(summary, now, "updatedAt", counts).withColumn("hour_key", hour_key(F.col("timestamp")))
        rows = rows.coalesce(1)
    else:
        rows = one_task_per_key(latest_per_hour(valid_counted(summary, counts)), "hour_key")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("hour_key").parquet(path)
    return counts.get["skipped"]


def append_warehouse(summary: DataFrame, path: str, now: datetime) -> int:
    """Append rows in warehouse shape; returns how many invalid rows were left out."""
    counts = Observation()
    to_warehouse_shape(_stamped(summary, now, "updated_at", counts)).write.mode("append").parquet(path)
    return counts.get["skipped"]
