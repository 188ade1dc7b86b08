"""Shards, chunks, progress and records of a labelling run."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sentilake.functions.keys import chunk_name, shard_name
from sentilake.operators.numbering import running_offsets
from sentilake.schemas import CHUNK_SIZE, LEASE_WINDOW, SHARD_SIZE, WORKER_CHUNK_SIZE
from sentilake.session import materialize

#: Bytes of a bitmap, and of all bitmaps together up to which they are sent to every task.
BITMAP_BYTES, BROADCAST_BYTES = 4096, 64 << 20
PENDING, IN_PROGRESS, COMPLETED = "PENDING", "IN_PROGRESS", "COMPLETED"


def index_rows(dataset: DataFrame) -> DataFrame:
    """Add ``row_idx``, the 0-based row number of a published Parquet dataset.

    A row's number is its place in its file plus the rows of the files before it.
    Both come from file metadata, so nothing is sorted or shuffled and a retried
    task finds the same numbers. Only the per-file counts are put in order, one small
    row per file, in groups.
    """
    rows = dataset.withColumns({
        "_file": F.col("_metadata.file_path"), "_place": F.col("_metadata.row_index")})
    counts = dataset.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count("*").alias("_n"))
    offsets = running_offsets(counts, ["_file"], "_n", "_before").drop("_n")
    return rows.join(offsets, "_file") \
        .withColumn("row_idx", F.col("_before") + F.col("_place")).drop("_file", "_place", "_before")


def assign_shards(indexed: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Add the shard of every row."""
    shard = F.floor(F.col("row_idx") / shard_size)
    return indexed.withColumn("shard_id", shard_name(shard))


def shard_manifest(
    spark: SparkSession, n: int, now: datetime, shard_size: int = SHARD_SIZE,
    chunk_size: int = CHUNK_SIZE,
) -> DataFrame:
    """One waiting task per shard of an ``n``-row dataset; bounds are inclusive."""
    start = F.col("id") * shard_size
    end = F.least(start + shard_size, F.lit(n)) - 1
    stamp = F.lit(now).cast("timestamp")
    return spark.range(-(-n // shard_size)).select(
        shard_name(F.col("id")).alias("shard_id"),
        F.lit(PENDING).alias("status"),
        start.alias("start_idx"),
        end.alias("end_idx"),
        F.ceil((end - start + 1) / chunk_size).alias("chunk_total"),
        F.lit(0).cast("bigint").alias("chunk_done"),
        F.lit(None).cast("string").alias("lease_owner"),
        F.lit(None).cast("timestamp").alias("lease_expires_at"),
        F.lit(0).alias("attempts"),
        stamp.alias("updated_at"),
    )


def chunk_ranges(manifest: DataFrame, chunk_size: int = WORKER_CHUNK_SIZE) -> DataFrame:
    """Chunks left in each shard; ``chunk_done`` counts finished records."""
    start = F.col("start_idx") + F.col("chunk_done")
    left = manifest.filter(start <= F.col("end_idx"))
    low = F.explode(F.sequence(start, F.col("end_idx"), F.lit(chunk_size).cast("bigint")))
    high = F.least(F.col("lo") + chunk_size - 1, F.col("end_idx"))
    return left.select("shard_id", "end_idx", low.alias("lo")).select(
        "shard_id", "lo", high.alias("hi")).withColumn("chunk", chunk_name(F.col("lo"), F.col("hi")))


def lease_candidates(tasks: DataFrame, now: datetime, n: int = LEASE_WINDOW) -> DataFrame:
    """Tasks a worker could take now, out of the ``n`` open ones updated longest ago."""
    window = tasks.filter(F.col("status").isin(PENDING, IN_PROGRESS)) \
        .orderBy("updated_at", "shard_id").limit(n)
    lease = F.col("lease_expires_at")
    free = (F.col("status") == PENDING) | lease.isNull() | (lease < F.lit(now).cast("timestamp"))
    return window.filter(free)


def pending_rows(dataset: DataFrame, done: DataFrame, key: str = "post_id") -> DataFrame:
    """Rows without an annotation yet, by id. Rows without an id are always pending; see
    :func:`pending_by_index`."""
    return dataset.join(done.select(key), key, "left_anti")


def finished_bitmaps(records: DataFrame, index_col: str = "row_idx") -> DataFrame:
    """``(bucket, bits)``: the row numbers of the records, a bit each, 32,768 to a bitmap."""
    place = F.col(index_col) + 1
    return records.where(F.col(index_col).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))


def has_bit(bits: Column, position: Column) -> Column:
    byte = F.ascii(F.decode(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    return F.get(F.array(*[F.shiftright(byte, i) for i in range(8)]), (position % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def pending_by_index(indexed: DataFrame, records: DataFrame, index_col: str = "row_idx",
                     broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of a numbered dataset whose number no record has yet, with or without an id.

    A bitmap has a bit per row, so half a billion finished rows fit under the default
    bound and are tested where the rows are read; no row is shuffled. Above it the rows
    meet the bitmaps in a join.
    """
    bitmaps = materialize(finished_bitmaps(records, index_col), "bitmaps")
    if bitmaps.count() * BITMAP_BYTES <= broadcast_bytes:
        bitmaps = F.broadcast(bitmaps)
    place = F.col(index_col) + 1
    met = indexed.withColumn("bucket", F.bitmap_bucket_number(place)).join(bitmaps, "bucket", "left")
    done = F.coalesce(has_bit(F.col("bits"), F.bitmap_bit_position(place)), F.lit(False))
    return met.where(~done).select(*indexed.columns)


def annotation_records(scored: DataFrame, run_id: str, model_id: str, worker_id: str,
                       id_col: str = "post_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Output records; an unusable answer keeps its row with NULL scores."""
    return scored.select(
        F.col(id_col).alias("id"), "scores", F.lit(model_id).alias("model_id"),
        F.lit(run_id).alias("run_id"), F.lit(worker_id).alias("worker_id"), *keep)


def annotation_metrics(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("items_annotated"),
                       F.count_if(F.col("scores").isNull()).alias("json_parse_failures"))


def annotation_progress(tasks: DataFrame, now: datetime) -> DataFrame:
    """Shards, finished records, expired leases and attempts by status."""
    expired = (F.col("status") == IN_PROGRESS) & F.coalesce(
        F.col("lease_expires_at") < F.lit(now).cast("timestamp"), F.lit(True))
    return tasks.groupBy("status").agg(
        F.count("*").alias("n_shards"), F.sum("chunk_done").alias("records_done"),
        F.count_if(expired).alias("expired_leases"), F.sum("attempts").alias("attempts"))


def combine_annotations(dataset: DataFrame, annotations: DataFrame, key: str = "post_id") -> DataFrame:
    """Extension: the dataset with its scores, NULL where not annotated."""
    found = annotations.select(F.col("id").alias(key), "scores", "model_id", "run_id")
    return dataset.join(found, key, "left")
