"""Post archives and published datasets."""

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from sentilake.functions.keys import hour_id, iso_timestamp
from sentilake.operators.posts import conform_posts, post_json
from sentilake.session import one_task_per_key


def write_archive(posts: DataFrame, path: str, run_ts: datetime) -> str:
    """All posts of a run under its ISO run time, one JSON object per line.

    NULL fields are left out. Lines keep the archive splittable; no task sees the
    whole run.
    """
    target = f"{path}/{run_ts.strftime('%Y-%m-%dT%H-%M-%S.%f')}"
    posts.select(post_json(posts).alias("value")).write.mode("overwrite").text(target)
    return target


def write_hourly_post_archive(posts: DataFrame, path: str, ts: datetime | str) -> None:
    """Posts by hour, with an index row (count, archived_at) per hour.

    A time puts all posts under that hour, and an empty input writes count 0. A
    column name files each post under its own hour. Writing an hour again replaces
    it. The rebalance splits hours that hold very many posts over several files.
    """
    rows = conform_posts(posts)
    if isinstance(ts, str):
        stamped = rows.withColumns({"hour_id": hour_id(F.col(ts)), "_at": F.col(ts)})
        index = stamped.groupBy("hour_id").agg(
            F.count("*").alias("count"), iso_timestamp(F.max("_at")).alias("archived_at"))
        spread = stamped.drop("_at").hint("rebalance", "hour_id")
        for part, name in ((spread, "posts"), (one_task_per_key(index, "hour_id"), "index")):
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("hour_id").parquet(f"{path}/{name}")
        return
    key = ts.strftime("%Y%m%d%H")
    stamp = iso_timestamp(F.lit(ts).cast("timestamp"))
    rows.write.mode("overwrite").parquet(f"{path}/posts/hour_id={key}")
    rows.agg(F.count("*").alias("count")).withColumn("archived_at", stamp) \
        .write.mode("overwrite").parquet(f"{path}/index/hour_id={key}")


def publish_dataset(df: DataFrame, path: str, revision: str) -> None:
    """Write a dataset revision; a published revision never changes."""
    df.write.mode("errorifexists").parquet(f"{path}/revision={revision}")
