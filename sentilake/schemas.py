"""Row layouts and fixed values shared by every module."""

from pyspark.sql import types as T

# Emotion labels, in reporting order.
EMOTIONS = ("joy", "sadness", "anger", "fear", "love", "surprise")

# Defaults of the sentiment run.
TEMPERATURE = 1.5
TOP_K = 3
MAX_POST_AGE_DAYS = 7
FETCH_BUFFER = 100
REQUIRED_POSTS = 15
COMMENTS_PER_POST = 5
MODEL_TAG = "bert"
AUTHOR_PLACEHOLDER = "[deleted]"
MODERATOR = "AutoModerator"
SITE_BASE_URL = "https://reddit.com"
PREVIEW_CHARS = 1024
POST_CHARS = 1400
COMMENT_COUNT = 300
MODEL_CHARS = 512
DAY_RANGE_LIMIT = 100
UNKNOWN_COMMUNITY = "unknown"
LISTING_METHODS = ("hot", "new", "top")

# Defaults of a labelling run.
SHARD_SIZE = 2048
CHUNK_SIZE = 256
WORKER_CHUNK_SIZE = 1024
LEASE_WINDOW = 25
SCORE_MIN = 1
SCORE_MAX = 10

COMMENT = T.StructType([
    T.StructField("body", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("created_utc", T.TimestampType()),
])

SENTIMENT = T.StructType([T.StructField(e, T.DoubleType()) for e in EMOTIONS])

SCORES = T.StructType([T.StructField(e, T.IntegerType()) for e in EMOTIONS])

POST = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("post_url", T.StringType()),
    T.StructField("post_title", T.StringType()),
    T.StructField("post_text", T.StringType()),
    T.StructField("post_text_preview", T.StringType()),
    T.StructField("post_created_ts", T.TimestampType()),
    T.StructField("post_score", T.LongType()),
    T.StructField("post_comment_count", T.LongType()),
    T.StructField("post_comments", T.ArrayType(COMMENT)),
    T.StructField("post_subreddit", T.StringType()),
    T.StructField("contribution", T.DoubleType()),
    T.StructField("sentiment", SENTIMENT),
    T.StructField("processing_timestamp", T.TimestampType()),
    T.StructField("sentiment_analysis_model", T.StringType()),
    T.StructField("sentiment_model_version", T.StringType()),
])

# Landed listing records: what a community listing yields before any filter.
LISTING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("permalink", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("num_comments", T.LongType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("listing_rank", T.LongType()),
    T.StructField("comments", T.ArrayType(T.StructType([
        T.StructField("body", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("created_utc", T.DoubleType()),
    ]))),
])

CONTRIBUTOR = T.StructType([
    T.StructField("emotion", T.StringType()),
    T.StructField("top_posts", T.ArrayType(POST)),
])

SUMMARY = T.StructType(
    [T.StructField(e, T.DoubleType()) for e in EMOTIONS]
    + [
        T.StructField("top_contributors", T.ArrayType(CONTRIBUTOR)),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("updatedAt", T.TimestampType()),
    ]
)

# Accepted older names, new name -> older names in order of preference.
LEGACY_POST_NAMES = {
    "post_id": ("id",),
    "post_url": ("url",),
    "post_title": ("title",),
    "post_text": ("text",),
    "post_created_ts": ("created", "created_utc"),
    "post_score": ("score",),
    "post_comment_count": ("num_comments",),
    "post_comments": ("comments",),
    "post_subreddit": ("subreddit",),
    "sentiment_analysis_model": ("sentiment_source_model",),
}
