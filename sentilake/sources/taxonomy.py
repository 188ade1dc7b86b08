"""Category taxonomy: JSON objects from category to a list of communities."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_taxonomy(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Rows (category, subreddit, category_pos, community_pos) in file order.

    ``lines`` reads one object per line in place of one per file. Anything but an
    object fails the read.
    """
    raw = spark.read.text(path, wholetext=not lines)
    parsed = F.from_json("value", "map<string,array<string>>")
    checked = F.coalesce(parsed, F.raise_error(F.lit("a taxonomy must be a JSON object"))
                         .cast("map<string,array<string>>"))
    entries = raw.select(F.posexplode(F.map_entries(checked)).alias("category_pos", "e"))
    return entries.select("category_pos", F.col("e.key").alias("category"),
                          F.posexplode("e.value").alias("community_pos", "subreddit")) \
        .select("category", "subreddit", "category_pos", "community_pos")
