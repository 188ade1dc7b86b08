"""The test tables seen as posts, comments, taxonomies and history rows."""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sentilake.functions.keys import hour_key
from sentilake.functions.sentiment import emotion_struct
from sentilake.schemas import CONTRIBUTOR, EMOTIONS
from sentilake.session import use_utc

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
NOW_EPOCH = int(NOW.timestamp())
COMMENTS_WANTED = 3

# Word list of the default scorer.
LEXICON = {
    "the": "joy", "of": "joy",
    "and": "sadness",
    "to": "anger",
    "in": "fear", "der": "fear",
    "de": "love", "la": "love",
    "that": "surprise", "que": "surprise",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def created_epoch(doc_id: Column) -> Column:
    return F.lit(NOW_EPOCH) - (doc_id * 37 % 240) * 3600


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as landed listing rows; ``listing_rank`` follows doc_id."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("selftext"),
        created_epoch(doc).cast("double").alias("created_utc"),
        F.concat(F.lit("/r/"), "source", F.lit("/"), doc.cast("string")).alias("permalink"),
        (F.col("n_chars") % 997 - 20).alias("score"),
        (F.col("n_chars") % 50).alias("num_comments"),
        F.col("source").alias("subreddit"),
        doc.alias("listing_rank"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts with their input position."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("post_id"),
        doc.alias("position"),
        F.substring_index("text", "\n", 1).alias("post_title"),
        F.col("text").alias("post_text"),
        F.timestamp_seconds(created_epoch(doc)).alias("post_created_ts"),
        (F.col("n_chars") % 997 - 20).alias("post_score"),
        F.col("source").alias("post_subreddit"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as landed comments of the document with the same number."""
    author = F.when(F.col("role") == "system", "AutoModerator").otherwise(F.col("role"))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("id"),
        F.col("turn").alias("comment_order"),
        F.col("text").alias("body"),
        author.alias("author"),
        (F.col("turn") * 3 - 2).alias("score"),
        (created_epoch(F.col("conv_id")) + F.col("turn") * 60).cast("double").alias("created_utc"),
    )


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source in category N mod 5; src0 also in cat4."""
    n = F.regexp_extract("source", "[0-9]+", 0).cast("int")
    sources = table(spark, sf_dir, "documents").select("source").distinct().withColumn("n", n)
    homes = F.when(F.col("source") == "src0", F.array(F.lit(0), F.lit(4))) \
        .otherwise(F.array(F.col("n") % 5))
    return sources.select("source", "n", F.explode(homes).alias("category_pos")).select(
        F.concat(F.lit("cat"), F.col("category_pos").cast("string")).alias("category"),
        F.col("source").alias("subreddit"),
        "category_pos",
        F.col("n").alias("community_pos"),
    )


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored posts: one emotion each, the value as score."""
    return as_event_posts(table(spark, sf_dir, "events"))


def as_event_posts(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    one_hot = emotion_struct(lambda e: (F.col("event_id") % 6 == EMOTIONS.index(e)).cast("double"))
    return events.select(
        F.col("event_id").cast("string").alias("post_id"),
        F.col("event_id").alias("position"),
        ts.alias("post_created_ts"),
        F.floor("value").cast("bigint").alias("post_score"),
        F.col("event_type").alias("post_subreddit"),
        one_hot.alias("sentiment"),
        hour_key(ts).alias("hour_key"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stored summary rows; values over 1 make some of them invalid."""
    ts = F.col("ts").cast("timestamp")
    value = lambda e: F.when(F.col("event_id") % 6 == EMOTIONS.index(e), F.col("value") / 100).otherwise(0.0)
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", hour_key(ts).alias("hour_key"), ts.alias("timestamp"),
        ts.alias("updatedAt"), *[value(e).alias(e) for e in EMOTIONS],
        F.array().cast(f"array<{CONTRIBUTOR.simpleString()}>").alias("top_contributors"),
    )
