"""Hourly history from a stream of scored posts.

Sums of weights and weighted emotions add up over batches, and ranking by weighted
value does not depend on the denominator. So a day's whole past is one small state: sums
per hour, and the top posts per hour and emotion. Each batch folds its own sums and top
posts into the states of the days it touches, and the hours of those days are finished
from them and replaced in the history. Late posts simply touch their old day again.

A state is named by the last batch in it. A batch starts from the state before its own
number, so a replay makes the same state again and nothing counts twice; the state before
that one is not needed any more and is removed. A day has two states at most, however
many batches come, and only the folders of the days at hand are listed.
"""

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from sentilake.functions.keys import hour_key, hour_start
from sentilake.operators.posts import post_struct
from sentilake.operators.summary import (
    emotion_totals, nest_contributors, normalize_totals, rank_strengths, strengths,
)
from sentilake.schemas import EMOTIONS, TEMPERATURE, TOP_K
from sentilake.session import child_names, one_task_per_key, remove

KEYS = ["hour_key"]


def hourly_partials(posts: DataFrame, temperature: float = TEMPERATURE, k: int = TOP_K,
                    position_col: str = "position") -> tuple[DataFrame, DataFrame]:
    """(sums per hour, top posts per hour and emotion) of one batch of posts."""
    sums = emotion_totals(posts, KEYS, temperature)
    best = rank_strengths(strengths(posts, KEYS, temperature, position_col), KEYS, k, position_col)
    details = posts.select(*KEYS, position_col, post_struct(posts).alias("post"))
    top = best.join(details, [*KEYS, position_col]).select(
        *KEYS, F.col(position_col).alias("position"), "emotion", "strength", "post")
    return sums, top


def finish_hours(sums: DataFrame, top: DataFrame, k: int = TOP_K) -> DataFrame:
    """History rows from all partials of the hours at hand."""
    merged = sums.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in ("weight_total", *EMOTIONS)])
    averages = normalize_totals(merged)
    live = averages.filter("has_emotion").select(*KEYS, "weight_total")
    winners = rank_strengths(top, KEYS, k, "position").join(live, KEYS)
    post = F.col("post").withField("contribution", F.col("strength") / F.col("weight_total"))
    nested = nest_contributors(winners, KEYS, post)
    return averages.join(nested, KEYS, "left").select(*KEYS, *EMOTIONS, "top_contributors")


def fold(name: str, partials: DataFrame, k: int = TOP_K) -> DataFrame:
    """Partials of the same hours to one: ``sums`` add up, of ``top`` the first ``k`` stay."""
    if name == "sums":
        return partials.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("weight_total", *EMOTIONS)])
    return rank_strengths(partials, KEYS, k, "position").drop("rank")


def _save(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    by_day = df.withColumn("day", F.substring("hour_key", 1, 10))
    one_task_per_key(by_day, "day").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def _states(spark: SparkSession, path: str, day: str) -> dict[str, list[int]]:
    """Batch numbers of a day's states, by run."""
    names = lambda folder: [n.partition("=")[2] for n in child_names(spark, folder) if "=" in n]
    return {run: sorted(map(int, names(f"{path}/day={day}/run={run}"))) for run in names(f"{path}/day={day}")}


def _read(like: DataFrame, paths: Sequence[str]) -> DataFrame:
    empty = like.sparkSession.createDataFrame([], like.schema)
    return like.sparkSession.read.schema(like.schema).parquet(*paths) if paths else empty


def merge_batch(batch: DataFrame, batch_id: int, path: str, temperature: float = TEMPERATURE,
                k: int = TOP_K, position_col: str = "position", run: str = "0") -> None:
    """Fold one batch into the states and the hourly history below ``path``.

    The batch feeds sums, ranks and details, so it is kept while they are written: a
    model before it scores every post once. ``run`` names the stream that counts the
    batches; the states of several runs add up. A day whose state is of a later batch has
    this one in it already.
    """
    spark = batch.sparkSession
    batch = batch.persist()
    sums, top = hourly_partials(batch, temperature, k, position_col)
    day = F.substring("hour_key", 1, 10)
    days = [r["day"] for r in sums.select(day.alias("day")).distinct().collect()]  # as many as the batch touches
    finished = []
    for name, part in (("sums", sums), ("top", top)):
        folder = f"{path}/state/{name}"
        before = {d: _states(spark, folder, d).get(run, []) for d in days}
        base = {d: max((n for n in own if n < batch_id), default=None) for d, own in before.items()}
        folded = [d for d, own in before.items() if own and own[-1] > batch_id]
        old = [f"{folder}/day={d}/run={run}/upto={n}" for d, n in base.items() if n is not None and d not in folded]
        merged = fold(name, part.where(~day.isin(folded)).unionByName(_read(part, old)), k)
        _save(merged.withColumns({"run": F.lit(run), "upto": F.lit(batch_id)}), folder, ["day", "run", "upto"])
        for d, own in before.items():
            for n in own:
                if base[d] is not None and n < base[d]:
                    remove(spark, f"{folder}/day={d}/run={run}/upto={n}")
        last = [f"{folder}/day={d}/run={r}/upto={own[-1]}" for d in days for r, own in _states(spark, folder, d).items() if own]
        finished.append(fold(name, _read(part, last), k))
    batch.unpersist()
    if days:
        history = finish_hours(*finished, k)
        _save(history.withColumns({"timestamp": hour_start(F.col("hour_key")), "updatedAt": F.current_timestamp()}),
              f"{path}/history", ["day"])


def stream_history(
    posts: DataFrame, path: str, checkpoint: str, ts_col: str = "post_created_ts",
    position_col: str = "position", temperature: float = TEMPERATURE, k: int = TOP_K,
    **trigger,
) -> StreamingQuery:
    """Start the hourly history of a stream of scored posts; every late post counts.

    States are named by checkpoint and batch, so a stream that starts anew under another
    checkpoint adds to those of the old one.
    """
    run = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    keyed = posts.withColumn("hour_key", hour_key(F.col(ts_col)))
    return keyed.writeStream.option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda df, n: merge_batch(df, n, path, temperature, k, position_col, run)) \
        .trigger(**(trigger or {"availableNow": True})).start()
