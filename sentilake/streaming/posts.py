"""Streaming dedupe and incremental labelling."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from sentilake.functions.content import content_tie
from sentilake.operators.archives import comment_total
from sentilake.operators.labelling import annotation_records
from sentilake.operators.scoring import Generator, annotate_posts


def stream_best_copy(
    posts: DataFrame, ts_col: str, gap: str, size: Column | None = None,
    tie_cols: Sequence[str] = ("processing_timestamp",), id_col: str = "post_id",
) -> DataFrame:
    """The copy with the most comments of each id, as :func:`dedupe_posts` chooses it.

    Copies of an id that follow each other within ``gap`` are one session. Its state is the
    best copy so far, merged before the shuffle; it is emitted when the watermark, ``gap``
    behind the latest time, shows that no copy can follow. Rows without an id or a time
    are left out.
    """
    n = comment_total(F.col("post_comments")) if size is None else size
    # The greatest of these wins: most comments, latest ties (NULL last), least hash.
    order = F.struct(n.alias("n"), *tie_cols, (-content_tie(posts).cast("decimal(20,0)")).alias("tie"))
    timed = posts.where(F.col(id_col).isNotNull() & F.col(ts_col).isNotNull()).withWatermark(ts_col, gap)
    best = timed.groupBy(id_col, F.session_window(ts_col, gap).alias("_session")).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in posts.columns]), order).alias("_best"))
    return best.select("_best.*")


def stream_dedupe(posts: DataFrame, ts_col: str, delay: str, id_col: str = "post_id") -> DataFrame:
    """First-seen row per id within the watermark delay.

    The first copy is passed on at once. :func:`stream_best_copy` waits for the copy with
    the most comments.
    """
    return posts.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([id_col])


def stream_annotations(
    posts: DataFrame, load: Callable[[], Generator], path: str, checkpoint: str,
    run_id: str, model_id: str, worker_id: str, batch_size: int = 8, **trigger,
) -> StreamingQuery:
    """Label arriving posts; the checkpoint remembers which files are done."""
    records = annotation_records(annotate_posts(posts, load, batch_size), run_id, model_id, worker_id)
    return records.writeStream.format("json").option("checkpointLocation", checkpoint) \
        .option("path", path).option("ignoreNullFields", "false").partitionBy("run_id") \
        .trigger(**(trigger or {"availableNow": True})).start()
