"""Running offsets over tables of any length."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sentilake.session import materialize


def running_offsets(counts: DataFrame, order: Sequence[str], n: str, before: str) -> DataFrame:
    """Add ``before``, the sum of ``n`` over all rows that come earlier by ``order``.

    Two levels: rows are range-sorted into groups, a window adds up each group, and the
    sums of the groups, one number per task of the sort, are added up on the driver.
    """
    spark = counts.sparkSession
    grouped = materialize(counts.repartitionByRange(*order).withColumn("_group", F.spark_partition_id()), "offsets")
    starts, total = [], 0
    for r in grouped.groupBy("_group").agg(F.sum(n).alias("n")).orderBy("_group").collect():
        starts.append((r["_group"], total))
        total += r["n"] or 0
    starts = spark.createDataFrame(starts, "_group int, _start bigint")
    earlier = Window.partitionBy("_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return grouped.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).join(F.broadcast(starts), "_group") \
        .withColumn(before, F.col(before) + F.col("_start")).drop("_group", "_start")
