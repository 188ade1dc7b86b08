"""Readers of what the sinks write."""

from pyspark.sql import DataFrame, SparkSession

from sentilake.operators.summaries import to_warehouse_shape
from sentilake.schemas import SUMMARY
from sentilake.session import child_names, path_exists


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The current snapshot, the version written last; no rows when there is none.

    Only that version's folder is read.
    """
    versions = sorted(n for n in child_names(spark, path) if n.startswith("version="))
    if versions:
        return spark.read.parquet(f"{path}/{versions[-1]}")
    return spark.read.parquet(path) if path_exists(spark, path) else spark.createDataFrame([], SUMMARY)


def read_warehouse(spark: SparkSession, path: str) -> DataFrame:
    """Warehouse rows; no rows, in their layout, when there is no warehouse."""
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], SUMMARY).withColumnRenamed("updatedAt", "updated_at")
        return to_warehouse_shape(empty)
    return spark.read.parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Hourly history with its ``hour_key`` partition column as text."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], SUMMARY.add("hour_key", "string"))
    stored = spark.read.parquet(path)
    return stored.withColumn("hour_key", stored["hour_key"].cast("string"))


def read_dataset(spark: SparkSession, path: str, revision: str) -> DataFrame:
    """One revision of a published dataset."""
    return spark.read.parquet(f"{path}/revision={revision}")


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    return spark.read.parquet(f"{path}/runs/run_id={run_id}")


def read_shard_tasks(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    return spark.read.parquet(f"{path}/tasks/run_id={run_id}")
