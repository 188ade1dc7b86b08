"""Distinct counts that can be merged: a sketch per part, united for any set of parts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: 2**14 registers: a sketch is 8 KB or less, its standard error 1.04 / 2**7.
LOG_REGISTERS = 14
STANDARD_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)


def id_sketches(posts: DataFrame, by: Sequence[str], id_col: str = "post_id") -> DataFrame:
    """``(by, n_rows, ids)``: rows and a sketch of the ids of each part.

    Sketches are merged before the shuffle, so a part of any size sends one per task.
    Rows without an id count as rows only.
    """
    return posts.groupBy(*by).agg(F.count("*").alias("n_rows"), F.hll_sketch_agg(id_col, LOG_REGISTERS).alias("ids"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of larger parts; an id in several of them counts once."""
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("ids").alias("ids"))


def estimate(ids: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(ids), F.lit(0).cast("bigint"))


def sketched_stats(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``dataset_stats`` of any set of parts, from their sketches alone."""
    return merge_sketches(sketches, by).select(*by, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), estimate(F.col("ids")).alias("n_ids"))
