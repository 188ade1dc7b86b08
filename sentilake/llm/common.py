"""Helpers shared by the corpus operators."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from sentilake.session import materialize

#: Names that operators give their own columns start so; input columns never do.
OWN = "__llm_"


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words between the six ASCII white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fold(doc_id, folds: int) -> int:
    """Remainder that deals documents to training and held-out parts."""
    return zlib.crc32(str(doc_id).encode()) % folds


def fold_column(doc_id, folds: int):
    """``fold`` as a column; NULL ids count as the text "null"."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")), F.lit(folds))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_columns_last(df: DataFrame, **new) -> DataFrame:
    """Add columns; an input column of the same name (any case) gives way to the new one."""
    lower = {name.lower() for name in new}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in lower]
    return df.select(*kept, *[col.alias(name) for name, col in new.items()])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batches, rows: int = 512):
    """Arrow batches cut to a few rows each, so that what a task makes of one stays small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node in ``edges(a, b)``; component: the smallest node.

    Alternating large-star and small-star. A round is one written table in the shared
    folder, so lineage stays short and lost executors cost one round. A hub's
    neighbours are never gathered: minima are sums of partial minima, and the join
    that hands them back can be split by adaptive execution. NULL ends and self-links
    are ignored; an empty input gives an empty result.
    """
    spark = edges.sparkSession
    current = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    current = materialize(current, "cc")
    for _ in range(max_rounds):
        if _settled(current):
            break
        current = materialize(_small_star(_large_star(current)), "cc")
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select("b", "b").distinct())


def _settled(edges: DataFrame) -> bool:
    """Is every class a star: no node with two smaller neighbours, no centre with one?"""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("centre")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    by_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("centre").alias("centre"))
    return by_node.where("up > 1 or (up = 1 and centre = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


class SortedHashes:
    """A sorted array of 64-bit hashes with an index on their first bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        at = np.full(len(hashes), -1, np.int32)
        if not len(self.keys):
            return at
        last = len(self.keys) - 1
        place = np.minimum(self.starts[hashes >> self.shift], last)
        key = self.keys[place]
        at[key == hashes] = place[key == hashes]
        open_ = np.flatnonzero((key < hashes) & (place < last))
        place, wanted = place[open_], hashes[open_]
        while len(open_):
            place = place + 1
            key = self.keys[place]
            hit = key == wanted
            at[open_[hit]] = place[hit]
            more = (key < wanted) & (place < last)
            open_, place, wanted = open_[more], place[more], wanted[more]
        return at
