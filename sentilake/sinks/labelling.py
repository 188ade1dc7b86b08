"""Manifests and outputs of a labelling run."""

from pyspark.sql import DataFrame

from sentilake.session import one_task_per_key


def write_manifest(run: DataFrame, tasks: DataFrame, path: str, run_id: str) -> None:
    """Replace the run's metadata and shard tasks."""
    run.coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/run_id={run_id}")
    tasks.write.mode("overwrite").parquet(f"{path}/tasks/run_id={run_id}")


def write_annotations(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines by run, shard and worker.

    The default refuses an existing target. A resumed run passes ``append`` after
    the finished rows have been taken out. A shard has a bounded size, so each becomes
    one file.
    """
    one_task_per_key(records, "shard_id").write.mode(mode).partitionBy("run_id", "shard_id", "worker_id") \
        .option("ignoreNullFields", "false").json(path)
