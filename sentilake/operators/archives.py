"""Records of raw archives to posts, and the deduplicated dataset."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sentilake.functions.content import content_tie
from sentilake.functions.keys import epoch_or_timestamp
from sentilake.functions.sentiment import emotion_struct
from sentilake.operators.labelling import BROADCAST_BYTES
from sentilake.operators.positions import FILE, ROW, keep_rows, with_position
from sentilake.schemas import LEGACY_POST_NAMES, POST

#: Columns of a stored table that decide between copies.
SIZE, TIE = "_comments", "_content"


def is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def only_objects(records: DataFrame, col: str = "record") -> DataFrame:
    """Keep JSON objects."""
    return records.filter(is_object(F.col(col)))


def _read_comments(v: Column) -> Column:
    return F.transform(v, lambda c: F.struct(
        F.try_variant_get(c, "$.body", "string").alias("body"),
        F.try_variant_get(c, "$.author", "string").alias("author"),
        F.try_variant_get(c, "$.score", "bigint").alias("score"),
        epoch_or_timestamp(F.try_variant_get(c, "$.created_utc", "string")).alias("created_utc")))


def posts_from_records(records: DataFrame, col: str = "record", keep: Sequence[str] = ()) -> DataFrame:
    """JSON objects of any age to the post layout, under old or new field names."""
    v = F.col(col)

    def first_of(name: str, kind: str) -> Column:
        names = (name, *LEGACY_POST_NAMES.get(name, ()))
        return F.coalesce(*[F.try_variant_get(v, f"$.{n}", kind) for n in names])

    def read(name: str, kind: str) -> Column:
        if name == "post_comments":
            return _read_comments(first_of(name, "array<variant>"))
        if name == "sentiment":
            scores = emotion_struct(
                lambda e: F.coalesce(F.try_variant_get(v, f"$.sentiment.{e}", "double"), F.lit(0.0)))
            return F.when(F.try_variant_get(v, "$.sentiment", "map<string,variant>").isNotNull(), scores)
        if kind == "timestamp":
            return epoch_or_timestamp(first_of(name, "string"))
        return first_of(name, kind)

    return records.select(
        *keep, *[read(f.name, f.dataType.simpleString()).cast(f.dataType).alias(f.name) for f in POST.fields])


def other_fields(v: Column) -> Column:
    """JSON of the fields that the post layout has no place for; NULL when there are none."""
    known = [n for f in POST.fields for n in (f.name, *LEGACY_POST_NAMES.get(f.name, ()))]
    rest = F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, _: ~k.isin(*known))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def comment_total(comments: Column) -> Column:
    """Length of the comment list; 0 when it is not a list."""
    return F.when(comments.isNull(), 0).otherwise(F.size(comments))


def split_missing_ids(posts: DataFrame, id_col: str = "post_id") -> tuple[DataFrame, DataFrame]:
    """(rows with an id, rows without one)."""
    return posts.filter(F.col(id_col).isNotNull()), posts.filter(F.col(id_col).isNull())


def dedupe_posts(
    posts: DataFrame, id_col: str = "post_id", size: Column | None = None,
    tie_cols: Sequence[str] = ("processing_timestamp",),
) -> DataFrame:
    """One row per id, the one with the most comments; ``tie_cols`` descending decide ties.

    The rank filter limits each task to one row per id before the shuffle, so copies
    of one id never gather. What is still equal is told apart by content. Rows without
    an id are left out; see :func:`split_missing_ids`.
    """
    known, _ = split_missing_ids(posts, id_col)
    n = comment_total(F.col("post_comments")) if size is None else size
    w = Window.partitionBy(id_col).orderBy(n.desc(), *[F.desc_nulls_last(c) for c in tie_cols], content_tie(posts))
    return known.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def with_rank_columns(posts: DataFrame, size: Column | None = None) -> DataFrame:
    """Add what decides between copies, so that a stored table can be deduplicated without
    its texts: the number of comments and a hash of the whole row."""
    n = comment_total(F.col("post_comments")) if size is None else size
    return posts.withColumns({SIZE: n, TIE: content_tie(posts)})


def best_places(stored: DataFrame, id_col: str = "post_id", tie_cols: Sequence[str] = ("processing_timestamp",),
                only: Column | None = None) -> DataFrame:
    """Where the copies that stay are, in a Parquet table written by :func:`with_rank_columns`."""
    rows = with_position(stored)
    narrow = (rows if only is None else rows.where(only)).select(*dict.fromkeys((id_col, *tie_cols, SIZE, TIE, FILE, ROW)))
    return dedupe_posts(narrow, id_col, F.col(SIZE), (*tie_cols, TIE)).select(FILE, ROW)


def dedupe_stored(stored: DataFrame, id_col: str = "post_id", tie_cols: Sequence[str] = ("processing_timestamp",),
                  only: Column | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """:func:`dedupe_posts` of a Parquet table written by :func:`with_rank_columns`.

    Copies are ranked by those columns, the id and ``tie_cols`` alone; texts are read once,
    for the rows that stay, and neither shuffled nor sorted unless there are more rows than
    ``broadcast_bytes`` of bitmaps hold. ``only`` restricts the rows.
    """
    return keep_rows(stored, best_places(stored, id_col, tie_cols, only), broadcast_bytes).drop(SIZE, TIE)


def order_by_comments(posts: DataFrame, id_col: str = "post_id") -> DataFrame:
    """Most comments first; the id splits large runs of equal counts over tasks."""
    return posts.orderBy(comment_total(F.col("post_comments")).desc(), F.col(id_col))


def dataset_stats(posts: DataFrame, id_col: str = "post_id", approximate: bool = False) -> DataFrame:
    """Row count and number of ids; the count is combined per id before the shuffle."""
    ids = F.approx_count_distinct(id_col) if approximate else F.count_distinct(id_col)
    return posts.agg(F.count("*").alias("n_rows"), ids.alias("n_ids"))
