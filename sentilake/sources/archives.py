"""Raw JSON archives."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sentilake.operators.archives import is_object
from sentilake.sources.arrays import read_large_documents, splittable

#: Archives above this size are read by several tasks.
SPLIT_BYTES = 64 << 20


def parse_document(text: Column) -> Column:
    """Strictly one JSON value, or NULL; text after the value makes it invalid."""
    wrapped = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<variant>",
                          {"allowSingleQuotes": "false"})
    return F.when(F.size(wrapped) == 1, F.get(wrapped, F.lit(0)))


def document_records(v: Column) -> Column:
    """Records of a document: a list, the list under ``data``, or one object.

    NULL for anything else.
    """
    listed = F.try_variant_get(v, "$", "array<variant>")
    under_data = F.try_variant_get(v, "$.data", "array<variant>")
    return F.coalesce(listed, under_data, F.when(is_object(v), F.array(v)))


def read_documents(
    spark: SparkSession, path: str, lines: bool = False, glob: str | None = None,
    streaming: bool = False, clean_source: str = "off", archive_dir: str | None = None,
) -> DataFrame:
    """Rows (file_path, file_size, records); ``records`` is NULL for a broken document.

    An archive file is one JSON document and is read whole by one task; files spread
    over tasks, and :func:`read_records` splits large ones. Archives written here hold a
    document per line (``lines``) and split.
    As a stream, ``clean_source`` ("delete" or "archive") removes a file once its
    records have been committed; it is off by default.
    """
    reader = spark.read
    if streaming:
        reader = spark.readStream.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(path, wholetext=not lines)
    return raw.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"),
        document_records(parse_document(F.col("value"))).alias("records"))


def read_records(spark: SparkSession, path: str, lines: bool = False, glob: str | None = None,
                 split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows (file_path, failed, record): one per record, and one without a record for each
    broken or empty document.

    Files above ``split_bytes`` that hold one JSON array are read by many tasks, with the
    records that reading them whole would give.
    """
    docs = read_documents(spark, path, lines, glob)
    if not lines:
        docs = docs.where(~splittable(F.col("file_path"), F.col("file_size"), split_bytes))
    whole = docs.select("file_path", F.col("records").isNull().alias("failed"), F.explode_outer("records").alias("record"))
    if lines or not any_larger(spark, path, glob, split_bytes):
        return whole
    return whole.unionByName(read_large_documents(spark, path, split_bytes, parse_document, document_records, glob))


def any_larger(spark: SparkSession, path: str, glob: str | None, size: int) -> bool:
    """Is there a file above a size? From a listing of names and lengths alone."""
    listing = spark.read.format("binaryFile")
    if glob:
        listing = listing.option("pathGlobFilter", glob)
    return not listing.load(path).select("path", "length").where(splittable(F.col("path"), F.col("length"), size)).isEmpty()


def read_archives(spark: SparkSession, path: str, lines: bool = False, **options) -> DataFrame:
    """Rows (file_path, record) from every readable document; as a stream, options are
    those of :func:`read_documents`, else of :func:`read_records`."""
    if options.get("streaming"):
        docs = read_documents(spark, path, lines, **options)
        return docs.select("file_path", F.explode("records").alias("record"))
    return read_records(spark, path, lines, **options).where("record is not null").select("file_path", "record")


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(file_path, length, modified)`` of archive files, without reading them; times in milliseconds."""
    listing = spark.read.format("binaryFile")
    if glob:
        listing = listing.option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    return listing.load(path).select(meta["file_path"].alias("file_path"), meta["file_size"].alias("length"),
                                     F.unix_millis(meta["file_modification_time"]).alias("modified"))


def count_archives(spark: SparkSession, path: str, lines: bool = False, glob: str | None = None) -> int:
    """Number of archives, from a listing of names alone.

    An archive is a file; one written here (``lines``) is a folder of part files.
    """
    listing = spark.read.format("binaryFile")
    if glob:
        listing = listing.option("pathGlobFilter", glob)
    name = F.regexp_replace("path", "/[^/]*$", "") if lines else F.col("path")
    return listing.load(path).select(name.alias("archive")).distinct().count()


def require_min_archives(spark: SparkSession, path: str, n: int, lines: bool = False, glob: str | None = None) -> int:
    """Fail unless there are at least ``n`` archives; returns how many there are."""
    found = count_archives(spark, path, lines, glob)
    if found < n:
        raise ValueError(f"required archives: {n}; found: {found}")
    return found


def require_min_files(documents: DataFrame, n: int) -> DataFrame:
    """Fail unless the documents come from at least ``n`` files."""
    found = documents.select("file_path").distinct().count()
    if found < n:
        raise ValueError(f"required archives: {n}; found: {found}")
    return documents


def ingest_stats(documents: DataFrame) -> DataFrame:
    """Files, bytes, unreadable documents and records."""
    per_file = documents.groupBy("file_path").agg(
        F.first("file_size").alias("bytes"),
        F.count_if(F.col("records").isNull()).alias("failed"),
        F.sum(F.when(F.col("records").isNull(), 0).otherwise(F.size("records"))).alias("records"))
    return per_file.agg(
        F.count("*").alias("n_files"), F.sum("bytes").alias("n_bytes"),
        F.count_if(F.col("failed") > 0).alias("failed_files"), F.sum("records").alias("n_records"))
