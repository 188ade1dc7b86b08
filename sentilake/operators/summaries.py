"""Validation, layout conversion and time handling of summary rows."""

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from sentilake.functions.content import content_tie
from sentilake.functions.keys import day_key, hour_key, utc_midnight
from sentilake.functions.text import text_preview
from sentilake.operators.posts import valid_post_struct
from sentilake.schemas import CONTRIBUTOR, DAY_RANGE_LIMIT, EMOTIONS, POST, PREVIEW_CHARS

LEGACY_CONTRIBUTORS = "_top_contributor"

# Older post field -> current post field, in the older order.
LEGACY_POST_FIELDS = {
    "id": "post_id",
    "url": "post_url",
    "title": "post_title",
    "text": "post_text",
    "created": "post_created_ts",
    "num_comments": "post_comment_count",
    "score": "post_score",
    "subreddit": "post_subreddit",
    "comments": "post_comments",
    "contribution": "contribution",
    "sentiment": "sentiment",
    "processing_timestamp": "processing_timestamp",
    "sentiment_source_model": "sentiment_analysis_model",
    "sentiment_model_version": "sentiment_model_version",
}


# ---- validation ---------------------------------------------------------------

def valid_averages() -> Column:
    """Six averages in [0, 1]; an absent one counts as 0."""
    inside = [F.coalesce(F.col(e), F.lit(0.0)).between(0.0, 1.0) for e in EMOTIONS]
    return reduce(lambda a, b: a & b, inside)


def valid_contributors(tc: Column) -> Column:
    """Present, each with a label and a list of valid posts."""
    ok = F.forall(tc, lambda t: t["emotion"].isNotNull() & F.coalesce(
        F.forall(t["top_posts"], valid_post_struct), F.lit(False)))
    return F.coalesce(ok, F.lit(False))


def valid_summary() -> Column:
    return valid_averages() & valid_contributors(F.col("top_contributors"))


def validate_summaries(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (good, skipped)."""
    return df.filter(valid_summary()), df.filter(~valid_summary())


def valid_counted(df: DataFrame, counts: Observation | None = None) -> DataFrame:
    """The good rows; ``counts`` gets ``rows`` and ``skipped`` when they are evaluated."""
    if counts is not None:
        df = df.observe(counts, F.count("*").alias("rows"), F.count_if(~valid_summary()).alias("skipped"))
    return df.filter(valid_summary())


# ---- time ---------------------------------------------------------------------

def _prune(df: DataFrame, low: Column, high: Column | None = None) -> DataFrame:
    """Repeat a time bound on the partition columns of stored history."""
    for name, key in (("hour_key", hour_key), ("day", day_key)):
        if name in df.columns:
            stored = F.col(name).cast("string")
            df = df.filter(stored >= key(low))
            df = df if high is None else df.filter(stored <= key(high))
    return df


def recent_history(df: DataFrame, now: datetime, num_days: int) -> DataFrame:
    """Rows of the last ``num_days`` days, oldest first.

    The bound is repeated on the partition column so that stored history is pruned.
    """
    start = F.lit(now - timedelta(days=num_days)).cast("timestamp")
    return _prune(df, start).filter(F.col("timestamp") >= start).orderBy("timestamp", content_tie(df))


def history_by_day_range(df: DataFrame, start: date, end: date, limit: int | None = DAY_RANGE_LIMIT) -> DataFrame:
    """Rows between two UTC dates, both included, oldest first, at most ``limit`` (None: all).

    Written as a half-open time range, which file statistics can prune.
    """
    low, high = utc_midnight(start), utc_midnight(end + timedelta(days=1))
    found = _prune(df, low, high).filter((F.col("timestamp") >= low) & (F.col("timestamp") < high)) \
        .orderBy("timestamp", content_tie(df))
    return found if limit is None else found.limit(limit)


def latest_per_hour(df: DataFrame, key_col: str = "hour_key", tie_cols: tuple[str, ...] = ()) -> DataFrame:
    """Last row written in each hour; equal times are told apart by content."""
    w = Window.partitionBy(key_col).orderBy(F.desc("timestamp"), *[F.desc(c) for c in tie_cols], content_tie(df))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def normalize_history_timestamps(df: DataFrame, now: datetime) -> DataFrame:
    """Text times to UTC timestamps; ``updatedAt`` moves only on repaired rows.

    ``timestamp`` is text here; ``stored_as_text`` tells which rows need repair. A text
    that is no time stays in ``timestamp_text``, which is NULL for all other rows.
    """
    repaired = F.try_to_timestamp(F.col("timestamp"))
    touched = F.col("stored_as_text") & repaired.isNotNull()
    return df.withColumns({
        "updatedAt": F.when(touched, F.lit(now).cast("timestamp")).otherwise(F.col("updatedAt")),
        "timestamp_text": F.when(repaired.isNull(), F.col("timestamp")),
        "timestamp": repaired,
    })


def rollup_history(df: DataFrame, width: str = "1 day") -> DataFrame:
    """Extension: mean of the six averages per time window."""
    return df.groupBy(F.window("timestamp", width).alias("w")).agg(
        *[F.avg(e).alias(e) for e in EMOTIONS], F.count("*").alias("n_rows")
    ).select(F.col("w.start").alias("period_start"), "n_rows", *EMOTIONS)


# ---- layouts ------------------------------------------------------------------

def warehouse_post(p: Column, n: int = PREVIEW_CHARS) -> Column:
    """Post without its full text, with a preview instead."""
    return p.withField("post_text_preview", text_preview(p["post_text"], n)).dropFields("post_text")


def to_warehouse_shape(df: DataFrame, n: int = PREVIEW_CHARS) -> DataFrame:
    """Full texts out, previews in, for every contributing post."""
    slim = F.transform("top_contributors", lambda t: F.struct(
        t["emotion"].alias("emotion"),
        F.transform(t["top_posts"], lambda p: warehouse_post(p, n)).alias("top_posts")))
    return df.withColumn("top_contributors", slim)


def legacy_post(p: Column) -> Column:
    no_comments = F.array().cast(POST["post_comments"].dataType)
    filled = {"text": F.coalesce(p["post_text"], F.lit("")),
              "comments": F.coalesce(p["post_comments"], no_comments)}
    return F.struct(*[filled.get(old, p[new]).alias(old) for old, new in LEGACY_POST_FIELDS.items()])


def current_post(p: Column) -> Column:
    back = {new: p[old] for old, new in LEGACY_POST_FIELDS.items()}
    return F.struct(*[
        back.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in POST.fields])


def to_legacy_summary(df: DataFrame) -> DataFrame:
    """Contributor array to a map from emotion to posts with older field names.

    Entries of one emotion are put together in order, blank emotions are left out.
    """
    tc = F.coalesce("top_contributors", F.array().cast(f"array<{CONTRIBUTOR.simpleString()}>"))
    labelled = F.filter(tc, lambda t: F.coalesce(t["emotion"] != "", F.lit(False)))
    labels = F.array_distinct(F.transform(labelled, lambda t: t["emotion"]))

    def posts_of(label: Column) -> Column:
        own = F.filter(labelled, lambda t: t["emotion"] == label)
        no_posts = F.array().cast(CONTRIBUTOR["top_posts"].dataType)
        together = F.flatten(F.transform(own, lambda t: F.coalesce(t["top_posts"], no_posts)))
        return F.transform(together, legacy_post)

    as_map = F.map_from_arrays(labels, F.transform(labels, posts_of))
    return df.withColumns({
        **{e: F.coalesce(e, F.lit(0.0)) for e in EMOTIONS}, LEGACY_CONTRIBUTORS: as_map,
    }).drop("top_contributors")


def to_new_summary(df: DataFrame) -> DataFrame:
    """Rows of either layout to the current one; neither gives an empty list."""
    converted = F.transform(F.map_entries(LEGACY_CONTRIBUTORS), lambda kv: F.struct(
        kv["key"].alias("emotion"), F.transform(kv["value"], current_post).alias("top_posts")))
    empty = F.array().cast(f"array<{CONTRIBUTOR.simpleString()}>")
    choices = [converted, empty]
    if "top_contributors" in df.columns:
        choices.insert(0, F.col("top_contributors"))
    return df.withColumn("top_contributors", F.coalesce(*choices)).drop(LEGACY_CONTRIBUTORS)
