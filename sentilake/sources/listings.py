"""Landed community listings."""

from pyspark.sql import DataFrame, SparkSession

from sentilake.schemas import LISTING


def read_listings(
    spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None,
    clean_source: str = "off", archive_dir: str | None = None,
) -> DataFrame:
    """JSON listing records, as a batch or as a stream of arriving files.

    ``clean_source`` ("delete" or "archive") removes a file once a stream has
    committed it; it is off by default.
    """
    if not streaming:
        return spark.read.schema(LISTING).json(path)
    reader = spark.readStream.schema(LISTING).option("cleanSource", clean_source)
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)
