"""Projections, quality filters and validation of posts."""

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sentilake.functions.content import content_tie
from sentilake.functions.keys import epoch_or_timestamp
from sentilake.functions.sentiment import in_unit_range
from sentilake.functions.text import is_blank
from sentilake.schemas import (
    AUTHOR_PLACEHOLDER, COMMENTS_PER_POST, FETCH_BUFFER, LEGACY_POST_NAMES,
    LISTING_METHODS, MAX_POST_AGE_DAYS, MODEL_TAG, MODERATOR, POST, REQUIRED_POSTS,
    SITE_BASE_URL, UNKNOWN_COMMUNITY,
)


# ---- listing order and limits -------------------------------------------------

def order_listing(df: DataFrame, method: str) -> DataFrame:
    """Keep one listing method and give it an order column ``listing_order``.

    The landed rank decides; without one ``new`` falls back to creation time and
    ``top`` to score. ``hot`` has no public formula and needs the landed rank.
    """
    if method not in LISTING_METHODS:
        raise ValueError(f"method must be one of {LISTING_METHODS}")
    if "method" in df.columns:
        df = df.filter(F.col("method") == method)
    if "listing_rank" in df.columns:
        order = F.col("listing_rank").cast("double")
    elif method == "new":
        order = -F.col("created_utc").cast("double")
    elif method == "top":
        order = -F.col("score").cast("double")
    else:
        raise ValueError("a hot listing needs a landed listing_rank")
    return df.withColumn("listing_order", order)


def listing_head(
    df: DataFrame, n: int, community_col: str = "subreddit",
    order_cols: tuple[str, ...] = ("listing_order",),
) -> DataFrame:
    """First ``n`` rows of each community's listing, numbered in ``listing_pos``.

    The rank filter becomes a group limit before the shuffle, so each task sends at
    most ``n`` rows per community however many rows the community holds. NULL comes last.
    """
    w = Window.partitionBy(community_col).orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
    return df.withColumn("listing_pos", F.row_number().over(w)).filter(F.col("listing_pos") <= n)


# ---- projections --------------------------------------------------------------

def normalize_comment(c: Column) -> Column:
    """Landed comment to a model comment; times are UTC, a missing one is epoch 0."""
    return F.struct(
        c["body"].alias("body"),
        F.coalesce(F.nullif(c["author"], F.lit("")), F.lit(AUTHOR_PLACEHOLDER)).alias("author"),
        F.greatest(F.coalesce(c["score"], F.lit(0)), F.lit(0)).cast("bigint").alias("score"),
        F.timestamp_micros(
            (F.coalesce(c["created_utc"], F.lit(0.0)) * 1000000).cast("bigint")
        ).alias("created_utc"),
    )


def normalize_post(df: DataFrame) -> DataFrame:
    """Landed listing columns to post columns; other columns pass through."""
    mapped = {
        "post_id": F.col("id"),
        "post_url": F.concat(F.lit(SITE_BASE_URL), F.col("permalink")),
        "post_title": F.col("title"),
        "post_text": F.col("selftext"),
        "post_created_ts": epoch_or_timestamp(F.col("created_utc")),
        "post_score": F.col("score"),
        "post_comment_count": F.col("num_comments"),
        "post_comments": F.col("comments"),
        "post_subreddit": F.col("subreddit"),
    }
    used = {"id", "permalink", "title", "selftext", "created_utc", "score", "num_comments",
            "comments", "subreddit"}
    rest = [F.col(c) for c in df.columns if c not in used]
    return df.select(*[c.alias(n) for n, c in mapped.items()], *rest)


def unify_legacy_posts(df: DataFrame) -> DataFrame:
    """Accept older column names, preferring the new name where both hold a value."""
    present = set(df.columns)
    out = df
    for new, olds in LEGACY_POST_NAMES.items():
        found = [n for n in (new, *olds) if n in present]
        if not found or found == [new]:
            continue
        cols = [F.col(n) for n in found]
        if new == "post_created_ts":
            cols = [epoch_or_timestamp(c) for c in cols]
        out = out.withColumn(new, F.coalesce(*cols)).drop(*[n for n in found if n != new])
    return out


def coerce_timestamps(
    df: DataFrame, cols: tuple[str, ...] = ("post_created_ts", "processing_timestamp")
) -> DataFrame:
    """Epoch seconds or ISO text to UTC timestamps."""
    return df.withColumns({c: epoch_or_timestamp(F.col(c)) for c in cols if c in df.columns})


def stamp_run(df: DataFrame, now: datetime, model: str = MODEL_TAG) -> DataFrame:
    """One processing time and model tag for the run; blank community becomes unknown."""
    community = F.nullif(F.col("post_subreddit"), F.lit(""))
    return df.withColumns({
        "processing_timestamp": F.lit(now).cast("timestamp"),
        "sentiment_analysis_model": F.lit(model),
        "post_subreddit": F.coalesce(community, F.lit(UNKNOWN_COMMUNITY)),
    })


def conform_posts(df: DataFrame) -> DataFrame:
    """The full post layout in order, with NULL for absent fields."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in POST.fields
    ])


def post_struct(df: DataFrame) -> Column:
    """All post fields of ``df`` as one struct, absent ones NULL."""
    have = set(df.columns)
    return F.struct(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in POST.fields
    ])


def post_json(df: DataFrame) -> Column:
    """One JSON object per post, NULL fields omitted, ISO times."""
    return F.to_json(post_struct(df), {
        "ignoreNullFields": "true",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    })


# ---- filters ------------------------------------------------------------------

def has_content(title: Column, body: Column) -> Column:
    """Title or body holds something besides white space."""
    return ~(is_blank(title) & is_blank(body))


def within_max_age(created: Column, now: datetime, days: int = MAX_POST_AGE_DAYS) -> Column:
    """Created no earlier than ``days`` before ``now``; the cutoff itself is kept."""
    cutoff = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    return created >= cutoff


def valid_comment(body: Column, author: Column) -> Column:
    """Non-blank body, not written by the moderation bot."""
    return ~is_blank(body) & ~author.eqNullSafe(F.lit(MODERATOR))


def first_valid_comments(comments: Column, n: int = COMMENTS_PER_POST) -> Column:
    """First ``n`` valid comments of a nested array, normalised."""
    kept = F.slice(F.filter(comments, lambda c: valid_comment(c["body"], c["author"])), 1, n)
    return F.transform(kept, normalize_comment)


def nest_first_comments(
    comments: DataFrame, key: str, order_col: str, n: int | None,
    valid: Column | None = None, comment: Column | None = None,
) -> DataFrame:
    """First ``n`` valid comments of each post from a flat comment table.

    The group limit keeps at most ``n`` rows per post and task before the shuffle,
    so a post with any number of comments gathers into at most ``n`` array entries.
    None takes all, where a post's comments are known to fit a row.
    """
    body = F.struct("body", "author", "score", "created_utc") if comment is None else comment
    rows = comments if valid is None else comments.filter(valid)
    w = Window.partitionBy(key).orderBy(order_col)
    top = rows.select(key, order_col, body.alias("c")) \
        .withColumn("rn", F.row_number().over(w))
    top = top if n is None else top.filter(F.col("rn") <= n)
    gathered = F.sort_array(F.collect_list(F.struct("rn", "c")))
    return top.groupBy(key).agg(F.transform(gathered, lambda x: x["c"]).alias("post_comments"))


def min_comments(comments: Column, n: int = COMMENTS_PER_POST) -> Column:
    return F.size(comments) >= n


def quality_posts(
    listings: DataFrame, now: datetime, method: str = "hot",
    required_posts: int = REQUIRED_POSTS, comment_limit: int = COMMENTS_PER_POST,
    fetch_buffer: int = FETCH_BUFFER, max_post_age_days: int = MAX_POST_AGE_DAYS,
    comments: DataFrame | None = None,
) -> DataFrame:
    """Landed listings to the posts of a run.

    The buffer limit counts listing rows before any filter, ``required_posts`` counts
    what is left after all of them. Comments are nested in the listing, or come as a
    flat table (``id``, ``comment_order`` and the comment fields); then only comments
    of posts that passed the other filters are shuffled.
    """
    ordered = order_listing(listings, method)
    landed = ordered.withColumn("_tie", content_tie(ordered))
    # Ranked without bodies; the few winners fetch theirs, NULL or not. Ties go by id and
    # content, so the rank is the same wherever it is computed. Rows equal in everything
    # count as rows of the buffer and are one post.
    order = ("listing_order", "id", "_tie")
    keys = ["subreddit", *order]
    winners = listing_head(landed.select(*keys), fetch_buffer, order_cols=order).groupBy(*keys).agg(F.min("listing_pos").alias("listing_pos"))
    won = winners.select(*[F.col(c).alias(f"_w{c}") for c in keys], "listing_pos")
    same = [F.col(c).eqNullSafe(F.col(f"_w{c}")) for c in keys]
    head = landed.join(won, reduce(lambda a, b: a & b, same)).dropDuplicates(["subreddit", "listing_pos"])
    head = head.drop(*[f"_w{c}" for c in keys])
    head = head.filter(has_content(F.col("title"), F.col("selftext"))) \
        .filter(within_max_age(epoch_or_timestamp(F.col("created_utc")), now, max_post_age_days))
    if comments is None:
        kept = head.withColumn("comments", first_valid_comments(F.col("comments"), comment_limit))
    else:
        fields = F.struct("body", "author", "score", "created_utc")
        wanted = comments.join(head.select("id"), "id", "left_semi")
        nested = nest_first_comments(
            wanted, "id", "comment_order", comment_limit,
            valid_comment(F.col("body"), F.col("author")), normalize_comment(fields))
        kept = head.drop("comments").join(nested.withColumnRenamed("post_comments", "comments"), "id")
    kept = kept.filter(min_comments(F.col("comments"), comment_limit))
    return normalize_post(listing_head(kept, required_posts, order_cols=order).drop("_tie"))


# ---- validation ---------------------------------------------------------------

def comments_ok(comments: Column) -> Column:
    """Every comment has a body and no negative score; no comments is fine."""
    bad = F.exists(comments, lambda c: c["body"].isNull() | F.coalesce(c["score"] < 0, F.lit(False)))
    return F.coalesce(~bad, F.lit(True))


def valid_post(count: Column, comments: Column, sentiment: Column,
               created: Column, processed: Column) -> Column:
    """All rules of a post as one boolean that is never NULL."""
    yes = F.lit(True)
    return (
        F.coalesce(count >= 0, yes)
        & comments_ok(comments)
        & F.when(sentiment.isNull(), yes).otherwise(in_unit_range(sentiment))
        & F.coalesce(processed >= created, yes)
    )


def valid_post_struct(p: Column) -> Column:
    return valid_post(p["post_comment_count"], p["post_comments"], p["sentiment"],
                      p["post_created_ts"], p["processing_timestamp"])


def validate_posts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (good, quarantined); the second lists the broken rules per row."""
    false = F.lit(False)
    rules = {
        "negative comment count": F.coalesce(F.col("post_comment_count") < 0, false),
        "invalid comment": ~comments_ok(F.col("post_comments")),
        "sentiment out of range": F.when(F.col("sentiment").isNotNull(),
                                         ~in_unit_range(F.col("sentiment"))).otherwise(false),
        "processed before created": F.coalesce(
            F.col("processing_timestamp") < F.col("post_created_ts"), false),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    checked = df.withColumn("broken_rules", broken)
    good = checked.filter(F.size("broken_rules") == 0).drop("broken_rules")
    return good, checked.filter(F.size("broken_rules") > 0)
