"""Score-weighted sentiment summaries with top contributors.

A post weighs ``u = (1 + score) ** (1 / T)``; its softmax weight is ``u`` over the sum
of ``u`` in its group. Averages need only sums of ``u * value``, and ranking by
``u * value`` equals ranking by contribution, so no row is ever joined to a
denominator: sums combine before the shuffle, the top-k limit runs before the
shuffle, and the division happens on the few winners.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sentilake.functions.sentiment import popularity
from sentilake.operators.positions import FILE, ROW, fetch_rows, with_position
from sentilake.operators.posts import post_struct
from sentilake.schemas import EMOTIONS, TEMPERATURE, TOP_K


def scorable(df: DataFrame) -> DataFrame:
    """Posts that take part: scored by the model, with a positive score."""
    return df.filter(F.col("sentiment").isNotNull() & (F.col("post_score") > 0))


def softmax_denominator(posts: DataFrame, group_cols: Sequence[str] = (),
                        temperature: float = TEMPERATURE) -> DataFrame:
    """Sum of unnormalised weights per group."""
    u = popularity(F.col("post_score"), temperature)
    return posts.groupBy(*group_cols).agg(F.sum(u).alias("weight_total"))


def softmax_weights(posts: DataFrame, group_cols: Sequence[str] = (),
                    temperature: float = TEMPERATURE) -> DataFrame:
    """Add each kept post's ``weight``; weights of a group sum to one."""
    kept = posts.filter(F.col("post_score") > 0)
    u = popularity(F.col("post_score"), temperature)
    denominator = softmax_denominator(kept, group_cols, temperature)
    if not group_cols:
        return kept.withColumn("weight", u / denominator.scalar())
    return kept.join(denominator, list(group_cols)) \
        .withColumn("weight", u / F.col("weight_total")).drop("weight_total")


def emotion_totals(posts: DataFrame, group_cols: Sequence[str] = (),
                   temperature: float = TEMPERATURE, count: str | None = None) -> DataFrame:
    """Per group: sum of weights and of weighted emotion values, both mergeable; ``count``
    names a column for the number of posts."""
    u = popularity(F.col("post_score"), temperature)
    sums = [F.sum(u * F.col(f"sentiment.{e}")).alias(e) for e in EMOTIONS]
    number = [F.count("*").alias(count)] if count else []
    totals = scorable(posts).groupBy(*group_cols).agg(*number, F.sum(u).alias("weight_total"), *sums)
    return totals.filter(F.col("weight_total").isNotNull())


def normalize_totals(totals: DataFrame) -> DataFrame:
    """Weighted totals to averages that sum to one; all zero stays all zero."""
    total = sum((F.col(e) for e in EMOTIONS[1:]), F.col(EMOTIONS[0]))
    divisor = F.when(total == 0, F.lit(1.0)).otherwise(total)
    keep = [c for c in totals.columns if c not in EMOTIONS]
    return totals.select(*keep, *[(F.col(e) / divisor).alias(e) for e in EMOTIONS],
                         (total != 0).alias("has_emotion"))


def rank_strengths(long: DataFrame, group_cols: Sequence[str], k: int, position_col: str) -> DataFrame:
    """Top ``k`` rows per group and emotion; of equal rows the later position wins."""
    w = Window.partitionBy(*group_cols, "emotion").orderBy(F.desc("strength"), F.desc(position_col))
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def strengths(posts: DataFrame, group_cols: Sequence[str], temperature: float,
              position_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """Narrow rows (group, position, emotion, strength), six per kept post."""
    u = popularity(F.col("post_score"), temperature)
    ids = [*group_cols, position_col, *carry]
    narrow = scorable(posts).select(*ids, *[(u * F.col(f"sentiment.{e}")).alias(e) for e in EMOTIONS])
    return narrow.unpivot(ids, list(EMOTIONS), "emotion", "strength")


def top_contributors(
    posts: DataFrame, group_cols: Sequence[str] = (), temperature: float = TEMPERATURE,
    k: int = TOP_K, position_col: str = "position", carry: Sequence[str] = (),
) -> DataFrame:
    """Rows (group, emotion, rank, position, contribution) of the strongest posts.

    ``position_col`` is a stored input order, unique within a group. Groups whose
    emotions are all zero have no contributors. ``carry`` names small columns to keep.
    """
    top = rank_strengths(strengths(posts, group_cols, temperature, position_col, carry),
                         group_cols, k, position_col)
    totals = normalize_totals(emotion_totals(posts, group_cols, temperature)) \
        .filter("has_emotion").select(*group_cols, "weight_total")
    if group_cols:
        joined = top.join(totals, list(group_cols))
    else:
        joined = top.withColumn("weight_total", totals.select("weight_total").scalar()) \
            .filter(F.col("weight_total").isNotNull())
    return joined.withColumn("contribution", F.col("strength") / F.col("weight_total")) \
        .drop("strength", "weight_total")


def nest_contributors(winners: DataFrame, group_cols: Sequence[str], post: Column) -> DataFrame:
    """Winners to one ``top_contributors`` array per group (six emotions, k posts each)."""
    per_emotion = winners.groupBy(*group_cols, "emotion").agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank"), post.alias("p")))).alias("ranked"))
    place = F.array_position(F.array(*map(F.lit, EMOTIONS)), F.col("emotion"))
    entry = F.struct(place.alias("place"), "emotion", F.transform("ranked", lambda r: r["p"]).alias("top_posts"))
    drop_place = lambda t: F.struct(t["emotion"].alias("emotion"), t["top_posts"].alias("top_posts"))
    nested = F.transform(F.sort_array(F.collect_list(entry)), drop_place)
    return per_emotion.groupBy(*group_cols).agg(
        F.when(F.count("*") > 0, nested).alias("top_contributors"))


def with_details(winners: DataFrame, posts: DataFrame, keys: Sequence[str], position_col: str,
                 details: DataFrame | None, key_col: str) -> DataFrame:
    """Winners with the columns of their posts, and those only ``details`` has."""
    bounded = (lambda df: df) if keys else F.broadcast  # at most 6 * k rows without groups
    full = posts.join(bounded(winners), [*keys, position_col])
    if details is None:
        return full
    extra = [c for c in details.columns if c not in full.columns]
    return details.select(key_col, *extra).join(bounded(full), key_col)


def sentiment_summary(
    posts: DataFrame, group_cols: Sequence[str] = (), temperature: float = TEMPERATURE,
    k: int = TOP_K, position_col: str = "position", details: DataFrame | None = None,
    key_col: str = "post_id",
) -> DataFrame:
    """One row per group: six averages and ``top_contributors``.

    No row without a positively scored post; zeros and NULL contributors when every
    emotion is zero. Without ``group_cols`` the whole input is one group.

    ``posts`` is read three times, so scores should be written first. It may then be
    a narrow table (key, position, groups, score, sentiment) with the texts left in
    ``details``, one row per ``key_col``, which is read once for the winners.
    """
    keys = list(group_cols)
    averages = normalize_totals(emotion_totals(posts, keys, temperature))
    winners = top_contributors(posts, keys, temperature, k, position_col)
    return _nested(averages, with_details(winners, posts, keys, position_col, details, key_col), keys)


def _nested(averages: DataFrame, full: DataFrame, keys: Sequence[str]) -> DataFrame:
    nested = nest_contributors(full, keys, post_struct(full))
    shape = [*keys, *EMOTIONS]
    if keys:
        return averages.join(nested, keys, "left").select(*shape, "top_contributors")
    return averages.select(*shape, nested.select("top_contributors").scalar().alias("top_contributors"))


def community_partials(
    posts: DataFrame, temperature: float = TEMPERATURE, k: int = TOP_K, position_col: str = "listing_pos",
    community_col: str = "post_subreddit", carry: Sequence[str] = ("post_id",),
) -> tuple[DataFrame, DataFrame]:
    """(sums, top ``k`` posts per emotion) of each community; both can be merged over any
    set of communities, also with one of them twice."""
    keys = [community_col]
    top = rank_strengths(strengths(posts, keys, temperature, position_col, carry), keys, k, position_col)
    return emotion_totals(posts, keys, temperature), top.drop("rank")


def category_summary(
    posts: DataFrame, taxonomy: DataFrame, group_cols: Sequence[str] = (), temperature: float = TEMPERATURE,
    k: int = TOP_K, position_col: str = "listing_pos", run_order: bool = True, details: DataFrame | None = None,
    community_col: str = "post_subreddit", key_col: str = "post_id", stored: bool = False,
) -> DataFrame:
    """:func:`sentiment_summary` of posts under their categories, by the taxonomy's columns
    ``group_cols``; without any, of all of them together.

    A community in two categories weighs in both. Only its sums and its top posts meet the
    taxonomy, never its posts. Equal strengths rank by the run's order (category, community,
    ``position_col``) or, without ``run_order``, by ``position_col`` alone. ``posts`` has one
    row per ``key_col``. With ``stored`` it is a Parquet table as written: winners carry their
    places in it, texts are read from the winners' files only, and keys need not be unique.
    """
    keys = list(group_cols)
    carry = [key_col, FILE, ROW] if stored else [key_col]
    sums, top = community_partials(with_position(posts) if stored else posts, temperature, k, position_col, community_col, carry)
    tax = taxonomy.withColumnRenamed("subreddit", community_col)
    merged = sums.join(tax, community_col).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("weight_total", *EMOTIONS)])
    averages = normalize_totals(merged.where("weight_total is not null"))
    place = F.struct("category_pos", "community_pos", position_col) if run_order else F.col(position_col)
    best = rank_strengths(top.join(tax, community_col).withColumn("_place", place), keys, k, "_place")
    live = averages.filter("has_emotion").select(*keys, "weight_total")
    if keys:
        winners = best.join(live, keys)
    else:
        winners = best.withColumn("weight_total", live.select("weight_total").scalar()).filter("weight_total is not null")
    winners = winners.select(*keys, "emotion", "rank", *carry, (F.col("strength") / F.col("weight_total")).alias("contribution"))
    bounded = (lambda df: df) if keys else F.broadcast  # at most 6 * k rows without groups
    full = fetch_rows(posts, winners.drop(key_col)) if stored else posts.join(bounded(winners), key_col)
    if details is not None:
        extra = [c for c in details.columns if c not in full.columns]
        full = details.select(key_col, *extra).join(bounded(full), key_col)
    return _nested(averages, full, keys)
