"""Large JSON archives, one array each, read by many tasks.

A file is cut where Spark cuts it, at closing braces: the text reader takes them as the
ends of lines, wherever the file lies. What a place in a file means depends on all that
comes before it, but little of that matters: whether the place is inside a string, and how
deep it is nested. A first pass finds, for either answer to the first question, what each
block does to both; a running sum over the blocks of a file, one small row each, gives
every block its start; a second pass cuts each block at the commas of the outermost list.
The pieces of an element that lies across blocks are put together, then every element is
parsed as a document of its own.

A file is valid when all its elements are and nothing else stands between, before or
behind them, so the result equals that of parsing the whole file. A file that is no array
is one element and is put together whole.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from sentilake.session import materialize

#: Bytes that are looked at together; a block of a file is a sequence of such chunks.
CHUNK = 1 << 20
ESCAPED = re.compile(rb"\\.", re.DOTALL)
QUOTE, COMMA, OPEN, CLOSE = b'",[]'
STEP = np.zeros(256, np.int8)
STEP[list(b"{[")], STEP[list(b"}]")] = 1, -1


def splittable(path: Column, size: Column, larger_than: int) -> Column:
    """Is a file above the size, and not compressed?"""
    return (size > larger_than) & ~path.rlike(r"[.](gz|bz2|deflate|lz4|snappy|zst)$")


def outline(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes without escapes, whether quotes before or at each are odd in number, and brace steps."""
    plain = np.frombuffer(ESCAPED.sub(b"__", data), np.uint8)
    odd = np.bitwise_xor.accumulate(plain == QUOTE)
    return plain, odd, STEP[plain]


def effect(data: bytes) -> tuple[int, int, int]:
    """Whether the quotes are odd in number, and the change of depth when ``data`` begins
    outside and inside a string."""
    if not data:
        return 0, 0, 0
    _, odd, step = outline(data)
    return int(odd[-1]), int(step[~odd].sum()), int(step[odd].sum())


def after(first: tuple[int, int, int], then: tuple[int, int, int]) -> tuple[int, int, int]:
    """The effect of one text and another behind it."""
    odd, outside, inside = first
    return odd ^ then[0], outside + then[1 + odd], inside + then[2 - odd]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(file, size, block, chunk, is the block's last, bytes)`` of consecutive pieces
    ``(file, size, block, piece)``, each with the brace that ended it."""
    key, number, held, size = None, 0, [], 0
    for batch in batches:
        for *own, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (own != key or size >= CHUNK):
                yield *key, number, own != key, b"".join(held)
                number, held, size = 0 if own != key else number + 1, [], 0
            key = own
            held += (piece, b"}")
            size += len(piece) + 1
    if held:
        yield *key, number, True, b"".join(held)


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its length, its effect, and its first byte that is no space."""
    total, length, first, rows = (0, 0, 0), 0, None, []
    for file, size, block, _, last, data in chunks(batches):
        total, length = after(total, effect(data)), length + len(data)
        first = first or data.lstrip(b" \t\r\n")[:1] or None
        if last:
            rows.append((file, size, block, length, *total, first == b"["))
            total, length, first = (0, 0, 0), 0, None
    if rows:
        names = ["file", "size", "block", "length", "odd", "outside", "inside", "list"]
        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))


def numbered_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the effect of what is before them in their block."""
    total = (0, 0, 0)
    for file, _, block, chunk, last, data in chunks(batches):
        yield pa.RecordBatch.from_pydict({
            "file": [file], "block": [block], "chunk": pa.array([chunk], pa.int32()), "ends": [last], "data": [data],
            **{n: pa.array([x], pa.int64()) for n, x in zip(("odd", "outside", "inside"), total)}})
        total = (0, 0, 0) if last else after(total, effect(data))


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text between the marks ``[ , ]`` of the outermost list; ``left`` and ``right`` are the
    marks beside it, ``^`` and ``$`` the ends of the file, NULL where a chunk ends."""
    for batch in batches:
        for r in batch.to_pylist():
            data = r["data"]
            whole_end = r["ends"] and r["last"]
            if whole_end and r["surplus"]:
                data = data[:-1]  # the last piece of the file was not ended by a brace
            marks: list[int] = []
            if r["list"] and data:
                plain, odd, step = outline(data)
                outside = odd == bool(r["state"] ^ r["odd"])
                depth = r["depth"] + r["inside" if r["state"] else "outside"] + np.cumsum(np.where(outside, step, 0), dtype=np.int64)
                opened = (plain == OPEN) & (depth == 1)
                closed = (step < 0) & (depth == 0)
                marks = np.flatnonzero(outside & (opened | closed | (plain == COMMA) & (depth == 1))).tolist()
            begin = "^" if r["block"] == 0 and r["chunk"] == 0 else None
            lefts = [begin, *(chr(data[m]) for m in marks)]
            rights = [*lefts[1:], "$" if whole_end else None]
            starts, ends = [0, *(m + 1 for m in marks)], [*marks, len(data)]
            n = len(lefts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["file"]] * n), pa.array([r["block"]] * n, pa.int64()), pa.array([r["chunk"]] * n, pa.int32()),
                 pa.array(range(n), pa.int32()), pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(starts, ends)], pa.string()),
                 pa.array(lefts, pa.string()), pa.array(rights, pa.string())],
                names=["file", "block", "chunk", "place", "text", "left", "right"])


def read_segments(spark: SparkSession, path: str, larger_than: int, glob: str | None = None) -> DataFrame:
    """``(file, text, left, right)`` of the files above a size: elements of lists, whole other documents."""
    reader = spark.read.option("lineSep", "}")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    pieces = reader.text(path).where(splittable(meta["file_path"], meta["file_size"], larger_than)).select(
        meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("piece"))
    blocks = pieces.mapInArrow(summaries, "file string, size long, block long, length long, odd long, outside long, inside long, list boolean")
    # One row per block of some 100 MB. Written, so that the files are read for it once.
    blocks = materialize(blocks, "json_blocks")
    in_file = W.partitionBy("file").orderBy("block")
    earlier = in_file.rowsBetween(W.unboundedPreceding, -1)
    state = F.coalesce(F.sum("odd").over(earlier) % 2, F.lit(0))
    own = F.when(F.col("state") == 0, F.col("outside")).otherwise(F.col("inside"))
    whole = W.partitionBy("file")
    starts = blocks.withColumn("state", state).withColumns({
        "depth": F.coalesce(F.sum(own).over(earlier), F.lit(0)), "last": F.lead("block").over(in_file).isNull(),
        "surplus": F.sum("length").over(whole) > F.col("size"), "list": F.first("list").over(in_file)})
    # No hint: a row per block is broadcast by Spark while it is small.
    placed = pieces.mapInArrow(
        numbered_chunks, "file string, block long, chunk int, ends boolean, data binary, odd long, outside long, inside long").join(
        starts.select("file", "block", "state", "depth", "last", "surplus", "list"), ["file", "block"])
    cut = placed.mapInArrow(segments, "file string, block long, chunk int, place int, text string, left string, right string")
    cut = materialize(cut, "json_segments")
    closed = F.col("left").isNotNull() & F.col("right").isNotNull()
    in_order = W.partitionBy("file").orderBy("block", "chunk", "place").rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = cut.where(~closed).withColumn("element", F.count("left").over(in_order))
    joined = F.sort_array(F.collect_list(F.struct("block", "chunk", "place", "text")))
    stitched = parts.groupBy("file", "element").agg(
        F.array_join(F.transform(joined, lambda p: p["text"]), "").alias("text"), F.max("left").alias("left"), F.max("right").alias("right"))
    names = ["file", "text", "left", "right"]
    return cut.where(closed).select(*names).union(stitched.select(*names))


def read_large_documents(spark: SparkSession, path: str, larger_than: int, parse, records_of, glob: str | None = None) -> DataFrame:
    """``(file_path, failed, record)``, a row per record of the files above a size.

    ``parse`` turns text into a JSON value or NULL, ``records_of`` a whole document's value
    into its records. A broken or empty file has one row without a record.
    """
    found = read_segments(spark, path, larger_than, glob)
    marks = F.concat(F.coalesce("left", F.lit("?")), F.coalesce("right", F.lit("?")))
    blank = F.col("text").rlike(r"^[ \t\r\n]*\z")
    element = marks.isin("[,", ",,", ",]") | (marks == "[]") & ~blank
    around = marks.isin("^[", "]$", "[]") & blank
    parsed = found.select("file", marks.alias("marks"), around.alias("around"), F.when(element | (marks == "^$"), parse(F.col("text"))).alias("value"))
    listed = F.when(F.col("marks") == "^$", records_of(F.col("value"))).otherwise(F.array("value"))
    parsed = parsed.withColumn("records", F.when(F.col("value").isNotNull(), listed)).select(
        "file", "around", "records", (~F.col("around") & F.col("records").isNull()).alias("bad"))
    parsed = materialize(parsed, "json_elements")
    files = parsed.groupBy("file").agg(F.max("bad").alias("failed"), F.sum(F.when(F.col("records").isNull(), 0).otherwise(F.size("records"))).alias("n"))
    good = parsed.where("not around").join(files.where("not failed").select("file"), "file").select(
        F.col("file").alias("file_path"), F.lit(False).alias("failed"), F.explode("records").alias("record"))
    none = files.where("failed or n = 0").select(
        F.col("file").alias("file_path"), "failed", F.lit(None).cast("variant").alias("record"))
    return good.unionByName(none)
