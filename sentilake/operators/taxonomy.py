"""Categories of communities."""

from pyspark.sql import DataFrame, functions as F

from sentilake.schemas import REQUIRED_POSTS


def join_taxonomy(posts: DataFrame, taxonomy: DataFrame, community_col: str = "post_subreddit") -> DataFrame:
    """One row per post and category; a community in two categories repeats its posts.

    No hint: Spark broadcasts the taxonomy when its size is under the session's
    threshold, and otherwise sorts and splits skewed communities.
    """
    tax = taxonomy.withColumnRenamed("subreddit", community_col)
    return posts.join(tax, community_col)


def flatten_categories(posts: DataFrame, taxonomy: DataFrame, community_col: str = "post_subreddit") -> DataFrame:
    """Run input in category order with a ``position`` that orders it totally."""
    joined = join_taxonomy(posts, taxonomy, community_col)
    rank = F.col("listing_pos") if "listing_pos" in posts.columns else F.col("post_id")
    return joined.withColumn("position", F.struct(
        F.col("category_pos"), F.col("community_pos"), rank.alias("listing_pos")))


def posts_per_community(posts: DataFrame, taxonomy: DataFrame, required: int = REQUIRED_POSTS,
                        community_col: str = "post_subreddit") -> DataFrame:
    """Collected posts per category and community with the shortfall.

    Posts are counted per community before they meet the taxonomy, so the join
    handles one row per community.
    """
    counts = posts.groupBy(community_col).agg(F.count("*").alias("n_posts"))
    tax = taxonomy.withColumnRenamed("subreddit", community_col)
    n = F.coalesce("n_posts", F.lit(0))
    return tax.join(counts, community_col, "left").select(
        "category", community_col, n.alias("n_posts"),
        F.greatest(F.lit(required) - n, F.lit(0)).alias("shortfall"))
