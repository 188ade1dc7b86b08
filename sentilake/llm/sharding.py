"""Two-pass external shuffle into shards.

Pass one scatters rows by a seeded hash into buckets that fit in memory and counts
them. Pass two loads one bucket at a time, puts it in Fisher-Yates order and gives its
rows the next free places of the whole order. Shards are equal stretches of that order,
so their row counts are at most one apart (the ``rows`` law), and a shard's files come
from few buckets.

Rules: a row's size is its UTF-8 bytes plus 8; NULL text has none. Rows that are equal
in all columns share a bucket and are interchangeable. An empty table gives empty shards. Columns of the
input named like those added here give way to them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, MapType, VariantType

from sentilake.llm.common import with_columns_last
from sentilake.operators.numbering import running_offsets

OVERHEAD = 8


def row_size(text: str):
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def external_shuffle(docs: DataFrame, shards: int = 24, *, id="doc_id", text="text", seed=17,
                     bucket_bytes: int = 8 << 20) -> DataFrame:
    """Every row with ``size``, its ``shard`` and its ``slot`` there (gapless from 0).

    The same rows and seed give the same places, whatever the partitions of the input.
    A bucket is the unit of memory: about ``bucket_bytes``, plus one row of any length.
    """
    total = docs.agg(F.count("*"), F.coalesce(F.sum(row_size(text)), F.lit(0))).first()
    n, n_buckets = total[0], max(1, math.ceil(total[1] / bucket_bytes))
    hashable = [F.col(f"`{c.name}`") for c in docs.schema if not isinstance(c.dataType, (MapType, VariantType))]
    place = F.xxhash64(F.lit(seed), F.col(id), F.col(text), *hashable)
    scattered = with_columns_last(
        docs, size=row_size(text), __llm_bucket=F.pmod(place, F.lit(n_buckets)),
        __llm_place=place, __llm_tie=F.xxhash64(F.lit(seed), *hashable),
    )
    counts = scattered.groupBy("__llm_bucket").agg(F.count("*").alias("__llm_rows"))
    # One row per bucket; its places start after those of all earlier buckets.
    starts = running_offsets(counts, ["__llm_bucket"], "__llm_rows", "__llm_start").drop("__llm_rows")

    def arrange(rows: pa.Table, start: pa.Table) -> pa.Table:
        if rows.num_rows:
            keys = [np.asarray(rows.column(c)) for c in ("__llm_tie", "__llm_place")]
            order = np.lexsort(keys)  # arrival order is not the same on a retry
            rng = np.random.default_rng([seed, rows.column("__llm_bucket")[0].as_py()])
            rows = rows.take(pa.array(order[fisher_yates(len(order), rng)]))
        at = np.arange(rows.num_rows, dtype=np.int64) + (start.column("__llm_start")[0].as_py() if start.num_rows else 0)
        shard = at * shards // max(n, 1)
        slot = at - -(-shard * n // shards)
        kept = rows.drop_columns(["__llm_bucket", "__llm_place", "__llm_tie"])
        kept = kept.drop_columns([c for c in kept.column_names if c.lower() in ("shard", "slot")])
        return kept.append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(slot))

    out = [f for f in scattered.schema if f.name.lower() not in ("shard", "slot", "__llm_bucket", "__llm_place", "__llm_tie")]
    schema = type(scattered.schema)(out).add("shard", IntegerType()).add("slot", LongType())
    return scattered.groupBy("__llm_bucket").cogroup(starts.groupBy("__llm_bucket")).applyInArrow(arrange, schema)


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation: each place, from the last, swaps with one at or before it."""
    order = np.arange(n)
    for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)).tolist()):
        order[i], order[j] = order[j], order[i]
    return order


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard (``shard=N``), rows in slot order within each file."""
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
