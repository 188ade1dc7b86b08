"""Hourly sums of weights, from which averages over any longer time follow.

A mean of hourly averages weighs a quiet hour like a busy one. The sums of weights and of
weighted emotion values add up, so a day made from its hours is the summary of its posts.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sentilake.functions.keys import day_key
from sentilake.operators.summary import emotion_totals, normalize_totals
from sentilake.schemas import EMOTIONS, TEMPERATURE

LEVELS = ("hour", "day", "week", "month")
SUMS = ("n_posts", "weight_total", *EMOTIONS)


def hourly_totals(posts: DataFrame, time_col: str = "post_created_ts", group_cols: Sequence[str] = (),
                  temperature: float = TEMPERATURE) -> DataFrame:
    """``(hour, group_cols, n_posts, weight_total, six sums)`` of the posts that take part.

    Posts without a time are left out; so are those the summary leaves out.
    """
    timed = posts.where(F.col(time_col).isNotNull()).withColumn("hour", F.date_trunc("hour", time_col))
    return emotion_totals(timed, ["hour", *group_cols], temperature, count="n_posts")


def append_totals(totals: DataFrame, path: str) -> None:
    """Store sums by day. Late posts are appended as sums of their own; readers add them up."""
    totals.withColumn("day", day_key(F.col("hour"))).write.mode("append").partitionBy("day").parquet(path)


def rollup_totals(totals: DataFrame, levels: Sequence[str] = LEVELS, group_cols: Sequence[str] = ()) -> DataFrame:
    """``(level, period_start, group_cols, n_posts, weight_total, six averages)`` in one pass.

    Each hour is expanded to its periods after hours are added up, so what is shuffled are
    sums per period and task. Averages of a period without any emotion are zero. Weeks
    begin on Monday.
    """
    unknown = [level for level in levels if level not in LEVELS]
    if unknown:
        raise ValueError(f"no such level: {unknown}")
    starts = totals.withColumns({f"_{level}": F.date_trunc(level, "hour") for level in levels})
    sets = [[F.col(f"_{level}"), *[F.col(c) for c in group_cols]] for level in levels]
    every = [F.col(f"_{level}") for level in levels] + [F.col(c) for c in group_cols]
    sums = starts.groupingSets(sets, *every).agg(
        F.grouping_id().alias("_set"), *[F.sum(c).alias(c) for c in SUMS])
    # The bit of a level's own column is the only one of the levels that is not set.
    width, all_levels = len(levels) + len(group_cols), (1 << len(levels)) - 1
    level = F.coalesce(*[F.when(F.col("_set") == (all_levels ^ (1 << (len(levels) - 1 - i))) << (width - len(levels)), F.lit(name))
                         for i, name in enumerate(levels)])
    start = F.coalesce(*[F.when(level == name, F.col(f"_{name}")) for name in levels])
    named = sums.select(level.alias("level"), start.alias("period_start"), *group_cols, *SUMS)
    return normalize_totals(named).drop("has_emotion")
