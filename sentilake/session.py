"""Session settings and shared working folders."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def use_utc(spark: SparkSession) -> SparkSession:
    """All time arithmetic is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="sentilake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(jpath)] if system.exists(jpath) else []


def file_state(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Length and modification time (milliseconds) of a file, None where there is none."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(jpath):
        return None
    status = system.getFileStatus(jpath)
    return status.getLen(), status.getModificationTime()


def input_bytes(df: DataFrame) -> int:
    """Length of the files that a table is made from."""
    spark, total = df.sparkSession, 0
    for name in df.inputFiles():
        jpath = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        total += jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath).getLen()
    return total


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all in it; tells whether it was there."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    The written table survives lost executors, so it is used wherever a result is
    read several times or must not be recomputed differently.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_task_per_key(df: DataFrame, key: str) -> DataFrame:
    """Spread small per-key rows over the session's shuffle tasks, one file per key.

    Hashing the key first makes this a partitioning of its own: asking for the one a
    preceding shuffle already has would leave the rows in that shuffle's few merged
    tasks.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64(key))


def spread(df: DataFrame) -> DataFrame:
    """Use every core for heavy per-row work on a scan with few splits.

    Few splits mean a small input, so the extra shuffle is small as well; a scan with
    at least as many splits as cores comes back unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
