"""Rows of stored Parquet tables by their place, so that wide columns stay where they are
until it is known which rows are wanted."""

from pyspark.sql import DataFrame, functions as F

from sentilake.operators.labelling import BITMAP_BYTES, BROADCAST_BYTES, has_bit
from sentilake.session import materialize

FILE, ROW = "_file", "_row"

#: Up to so many files are named to the scan, which then opens no others.
FEW_FILES = 1000


def with_position(stored: DataFrame) -> DataFrame:
    """Add the file of each row and its 0-based place there."""
    return stored.withColumns({FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})


def fetch_rows(stored: DataFrame, wanted: DataFrame, few: int = FEW_FILES) -> DataFrame:
    """The rows at the places in ``wanted``, with its other columns.

    For few rows of a large table: where their files are at most ``few``, only those are
    listed and opened. Otherwise all are scanned; the rows meet the same join.
    """
    wanted = materialize(wanted, "wanted")
    files = [r[0] for r in wanted.select(FILE).distinct().limit(few + 1).collect()]
    if len(files) <= few:
        stored = stored.where(F.col("_metadata.file_path").isin(files))
    return with_position(stored).join(wanted, [FILE, ROW]).drop(FILE, ROW)


def keep_rows(stored: DataFrame, wanted: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows at the places in ``wanted``, which may be most of them.

    Places become bitmaps, a bit per row and 32,768 rows to a bitmap, tested where the
    rows are read: nothing wide is shuffled. Bitmaps of more than ``broadcast_bytes``
    together (by default over half a billion rows) meet the rows in a join.
    """
    place = F.col(ROW) + 1
    bitmaps = materialize(wanted.groupBy(FILE, F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")), "places")
    if bitmaps.count() * BITMAP_BYTES <= broadcast_bytes:
        bitmaps = F.broadcast(bitmaps)
    met = with_position(stored).withColumn("_bucket", F.bitmap_bucket_number(place)).join(bitmaps, [FILE, "_bucket"])
    return met.where(has_bit(F.col("_bits"), F.bitmap_bit_position(place))).select(*stored.columns)
