"""Whole jobs: the sentiment run, the history reads, the dataset build and the labelling run."""

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sentilake.functions.text import comment_bodies, prepare_for_input
from sentilake.operators.archives import (
    SIZE, TIE, dedupe_stored, is_object, order_by_comments, other_fields, posts_from_records, split_missing_ids, with_rank_columns,
)
from sentilake.operators.labelling import (
    COMPLETED, IN_PROGRESS, PENDING, annotation_metrics, annotation_progress, annotation_records, assign_shards,
    index_rows, pending_by_index, shard_manifest,
)
from sentilake.operators.posts import quality_posts, stamp_run
from sentilake.operators.sketches import id_sketches, sketched_stats
from sentilake.operators.scoring import Generator, Scorer, annotate_posts, lexicon_scores, score_emotions
from sentilake.operators.summaries import (
    history_by_day_range, recent_history, to_legacy_summary, to_new_summary, valid_counted,
)
from sentilake.operators.summary import category_summary
from sentilake.operators.taxonomy import flatten_categories
from sentilake.schemas import CHUNK_SIZE, COMMENT_COUNT, DAY_RANGE_LIMIT, MODEL_CHARS, POST_CHARS, SCORES, SHARD_SIZE
from sentilake.session import file_state, materialize, path_exists, remove
from sentilake.sinks.archives import publish_dataset, write_archive
from sentilake.sinks.labelling import write_annotations, write_manifest
from sentilake.sinks.summaries import append_warehouse, upsert_history, write_current
from sentilake.sources.archives import SPLIT_BYTES, list_files, read_records, require_min_archives
from sentilake.sources.stores import read_dataset, read_history, read_latest, read_shard_tasks, read_warehouse


def score_posts(posts: DataFrame, scorer: Mapping[str, str] | Callable[[], Scorer], post_limit: int | None = POST_CHARS,
                comment_limit: int | None = COMMENT_COUNT, max_chars: int | None = MODEL_CHARS) -> DataFrame:
    """Model input from title, text and comments, scored by a word list or a model.

    None lifts a limit: characters of the body, number of comments, characters that a
    model gets. A word list reads the whole input.
    """
    text = prepare_for_input(F.col("post_title"), F.col("post_text"), comment_bodies(F.col("post_comments")),
                             post_limit, comment_limit)
    with_text = posts.withColumn("model_text", text)
    if isinstance(scorer, Mapping):
        scored = lexicon_scores(with_text, scorer, "model_text")
    else:
        scored = score_emotions(with_text, scorer, "model_text", max_chars=max_chars)
    return scored.drop("model_text")


def sentiment_run(
    listings: DataFrame, taxonomy: DataFrame, root: str, now: datetime,
    scorer: Mapping[str, str] | Callable[[], Scorer], method: str = "hot",
    num_posts: int = 15, num_comments: int = 5, buffer: int = 100,
    archive: bool = True, snapshot: bool = True, hourly: bool = True,
    comments: DataFrame | None = None, **limits: int | None,
) -> DataFrame:
    """Collect, score, summarise and store; returns the summary.

    Only communities of the taxonomy are collected; ``limits`` go to
    :func:`score_posts`. Posts are scored once per community and written before they meet the taxonomy,
    so a post in two categories is scored once but weighs twice. The written table
    feeds both the summary and the archive.
    """
    listings = listings.join(taxonomy.select("subreddit"), "subreddit", "left_semi")
    kept = quality_posts(listings, now, method, num_posts, num_comments, buffer, comments=comments)
    scored = materialize(stamp_run(score_posts(kept, scorer, **limits), now), "scored")
    summary = materialize(category_summary(scored, taxonomy, stored=True), "summary")
    if snapshot:
        write_current(summary, f"{root}/current", now)
    if hourly:
        upsert_history(summary, f"{root}/history", now)
        append_warehouse(summary, f"{root}/warehouse", now)
    if archive:
        write_archive(flatten_categories(scored, taxonomy), f"{root}/archive", now)
    return summary


def _in_layout(df: DataFrame, layout: str) -> DataFrame:
    return to_legacy_summary(df) if layout == "legacy" else df


def _current_layout(df: DataFrame, counts: Observation | None) -> DataFrame:
    """Either stored layout to the current one, without rows that fail validation."""
    unified = to_new_summary(df) if "_top_contributor" in df.columns else df
    return valid_counted(unified, counts)


def latest_sentiment(spark: SparkSession, root: str, layout: str = "legacy", counts: Observation | None = None) -> DataFrame:
    """The current snapshot in the wanted layout.

    ``counts``, here and below, gets the ``rows`` read and those ``skipped`` as invalid.
    """
    return _in_layout(_current_layout(read_latest(spark, f"{root}/current"), counts), layout)


def past_days(spark: SparkSession, root: str, now: datetime, num_days: int,
              layout: str = "legacy", counts: Observation | None = None) -> DataFrame:
    """Hourly history of the last ``num_days`` days (1, 7 and 31 in the service)."""
    rows = recent_history(read_history(spark, f"{root}/history"), now, num_days)
    return _in_layout(_current_layout(rows, counts), layout)


def warehouse_days(spark: SparkSession, root: str, start: date, end: date, limit: int | None = DAY_RANGE_LIMIT,
                   counts: Observation | None = None) -> DataFrame:
    """Warehouse rows between two dates, at most ``limit`` of them (None: all)."""
    return valid_counted(history_by_day_range(read_warehouse(spark, f"{root}/warehouse"), start, end, limit), counts)


def build_dataset(spark: SparkSession, archives: str, target: str, revision: str,
                  min_files: int = 1, lines: bool = False, ordered: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Archives to one published row per post; returns the report of the build.

    Archives above ``split_bytes`` that hold one JSON array are read by many tasks.

    Fields outside the post layout go along as JSON in ``extra``. Posts without an id go
    to the folder ``quarantine`` beside the revisions. Every record is accounted for:
    ``records = published + copies + quarantined + non_objects``; broken documents are
    counted by ``failed``. ``ordered`` sorts by number of comments. A journal of the files
    read, as they were, is kept for :func:`clean_up_source`; the report is written last.
    """
    found = require_min_archives(spark, archives, min_files, lines)
    journal = materialize(list_files(spark, archives), "journal")
    records = read_records(spark, archives, lines, split_bytes=split_bytes)
    state = F.when(F.col("failed"), "failed").when(F.col("record").isNull(), "empty") \
        .when(~is_object(F.col("record")), "non_object").otherwise("post")
    parsed = posts_from_records(records.withColumns({"state": state, "extra": other_fields(F.col("record"))}), keep=("file_path", "state", "extra"))
    parsed = materialize(with_rank_columns(parsed), "parsed")
    _, unnamed = split_missing_ids(parsed.filter("state = 'post'").drop("state", "file_path", SIZE, TIE))
    unique = dedupe_stored(parsed, only=F.col("state") == "post").drop("state", "file_path")
    publish_dataset(order_by_comments(unique) if ordered else unique, target, revision)
    unnamed.write.mode("overwrite").parquet(f"{target}/quarantine/revision={revision}")
    # One small row per archive, so that counts over any set of them need no second read.
    id_sketches(parsed.filter("state = 'post'"), ["file_path"]).write.mode("overwrite").parquet(f"{target}/sketches/revision={revision}")
    published = read_dataset(spark, target, revision).agg(F.count("*").alias("published"))
    whole = parsed.groupBy("file_path").agg(F.max(F.col("state") == "failed").alias("failed"))
    journal.join(whole, "file_path", "left").write.mode("overwrite").parquet(f"{target}/journal/revision={revision}")
    sizes = journal.agg(F.sum("length").alias("bytes"))
    report = parsed.agg(
        F.lit(found).cast("bigint").alias("archives"), F.count_if(F.expr("state = 'failed'")).alias("failed"),
        F.count_if(F.expr("state in ('non_object', 'post')")).alias("records"), F.count_if(F.expr("state = 'non_object'")).alias("non_objects"),
        F.count_if(F.expr("state = 'post' and post_id is null")).alias("quarantined"),
    ).withColumn("published", published.scalar()).withColumn(
        "copies", F.col("records") - F.col("non_objects") - F.col("quarantined") - F.col("published")) \
        .withColumn("bytes", sizes.scalar())
    # Written last: where there is a report, the revision and its journal are whole.
    report.coalesce(1).write.mode("overwrite").parquet(f"{target}/reports/revision={revision}")
    return spark.read.schema(report.schema).parquet(f"{target}/reports/revision={revision}")


def archive_stats(spark: SparkSession, target: str, revisions: Sequence[str], only: Column | None = None) -> DataFrame:
    """Posts and distinct ids in all archives of some builds, from their stored sketches alone.

    An archive that several builds read counts once; ``only`` chooses archives by ``file_path``.
    """
    parts = reduce(DataFrame.unionByName, [spark.read.parquet(f"{target}/sketches/revision={r}") for r in revisions])
    once = parts.groupBy("file_path").agg(F.max_by(F.struct("n_rows", "ids"), "n_rows").alias("s")).select("file_path", "s.*")
    return sketched_stats(once if only is None else once.where(only))


def clean_up_source(spark: SparkSession, target: str, revision: str) -> dict[str, int]:
    """Delete the archives of a published build; returns how many were removed and kept.

    Only after the build's report is there, and only files that are as the journal says
    they were when the build began (length and time) and whose documents were all read.
    What has gone already is passed over, so an interrupted call can be made again.
    """
    report = f"{target}/reports/revision={revision}"
    if not path_exists(spark, report):
        raise ValueError(f"no finished build of revision {revision}")
    r = spark.read.parquet(report).first()
    if read_dataset(spark, target, revision).count() != r["published"]:
        raise ValueError(f"revision {revision} is not what its report says")
    counts = {"removed": 0, "kept": 0, "gone": 0}
    # One file after the other: names pass through the driver a partition at a time.
    for f in spark.read.parquet(f"{target}/journal/revision={revision}").toLocalIterator(prefetchPartitions=True):
        now = file_state(spark, f["file_path"])
        if now is None:
            counts["gone"] += 1
        elif now == (f["length"], f["modified"]) and f["failed"] is False:
            remove(spark, f["file_path"])
            counts["removed"] += 1
        else:
            counts["kept"] += 1
    return counts


def label_run(spark: SparkSession, dataset: str, revision: str, target: str, run_id: str, now: datetime,
              load: Callable[[], Generator], model_id: str, worker_id: str, shard_size: int = SHARD_SIZE,
              chunk_size: int = CHUNK_SIZE, batch_size: int = 8, only: Column | None = None, **limits: int | None) -> DataFrame:
    """Label the posts of a dataset that have no record yet; returns the metrics of the run so far.

    Rows are numbered and dealt to shards; the manifest is written when the run begins.
    Calling it again goes on where it stopped, by row number, so rows without an id are
    labelled once as well. ``only`` restricts a call to some rows;
    ``limits`` are those of the prompt.
    """
    rows = assign_shards(index_rows(read_dataset(spark, dataset, revision)), shard_size)
    if not path_exists(spark, f"{target}/tasks/run_id={run_id}"):
        n = rows.count()
        run = spark.range(1).select(F.lit(n).alias("n_rows"), F.lit(revision).alias("revision"), F.lit(shard_size).alias("shard_size"),
                                    F.lit(chunk_size).alias("chunk_size"), F.lit(model_id).alias("model_id"), F.lit(now).alias("created_at"))
        write_manifest(run, shard_manifest(spark, n, now, shard_size, chunk_size), target, run_id)
    pending = rows if only is None else rows.filter(only)
    if path_exists(spark, f"{target}/records/run_id={run_id}"):
        pending = pending_by_index(pending, label_records(spark, target, run_id))
    done = annotate_posts(pending, load, batch_size, **limits)
    write_annotations(annotation_records(done, run_id, model_id, worker_id, keep=("shard_id", "row_idx")), f"{target}/records", "append")
    return annotation_metrics(label_records(spark, target, run_id))


def label_records(spark: SparkSession, target: str, run_id: str) -> DataFrame:
    """Records of a labelling run, with their shard and row number."""
    layout = StructType([StructField("id", StringType()), StructField("scores", SCORES), StructField("model_id", StringType()),
                         StructField("row_idx", LongType()),
                         StructField("shard_id", StringType()), StructField("worker_id", StringType())])
    return spark.read.schema(layout).json(f"{target}/records/run_id={run_id}").withColumn("run_id", F.lit(run_id))


def finish_labels(spark: SparkSession, dataset: str, revision: str, target: str, run_id: str) -> DataFrame:
    """The posts of a finished run with their scores, published as one dataset.

    Rows meet their records by number, so posts without an id get theirs and posts that
    share one get their own. A row that a lost worker left two records of takes one of
    them, an answer that could be used before one that could not. While a shard has rows
    without a record nothing is written.
    """
    one = label_records(spark, target, run_id).where("row_idx is not null").groupBy("row_idx").agg(
        F.max(F.struct("scores", "model_id", "worker_id")).alias("r"), F.min("shard_id").alias("shard_id"))
    one = materialize(one.select("row_idx", "shard_id", "r.*"), "answers")
    tasks = read_shard_tasks(spark, target, run_id).join(one.groupBy("shard_id").agg(F.count("*").alias("n")), "shard_id", "left")
    short = tasks.where(F.coalesce("n", F.lit(0)) < F.col("end_idx") - F.col("start_idx") + 1).count()
    if short:
        raise ValueError(f"run {run_id} has {short} unfinished shards")
    rows = index_rows(read_dataset(spark, dataset, revision)).join(one, "row_idx", "left")
    publish_dataset(rows, f"{target}/combined", run_id)
    return read_dataset(spark, f"{target}/combined", run_id)


def label_progress(spark: SparkSession, target: str, run_id: str, now: datetime) -> DataFrame:
    """Progress of a labelling run: the manifest with the records written so far."""
    counts = label_records(spark, target, run_id).groupBy("shard_id").agg(F.count("*").alias("n"))
    tasks = read_shard_tasks(spark, target, run_id).join(counts, "shard_id", "left")
    done = F.coalesce("n", F.lit(0))
    whole = done == F.col("end_idx") - F.col("start_idx") + 1
    status = F.when(whole, COMPLETED).when(done > 0, IN_PROGRESS).otherwise(PENDING)
    return annotation_progress(tasks.withColumns({"chunk_done": done, "status": status}), now)
