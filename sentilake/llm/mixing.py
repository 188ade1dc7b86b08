"""Mixing sources to target weights by weighted fair queueing.

Documents of a source queue up in a shuffled order (seeded hash). A document's virtual
finish time is the number of its source's words up to and including it, divided by the
source's weight. Sorted by that time over all sources, the head of the list holds the
sources in the ratio of their weights; a source that has been used ``max_repeats``
times leaves the queue, and the others go on in their ratio. All copies of all sources
are range-sorted by that time (at a document's middle), and the list ends where its words add up to the budget.

Rules: NULL text has no words. NULL is a source of its own and comes last. Repeated
rows are documents of their own. A source without words takes no part. Documents are
taken whole, so a source misses its target by half a document at most. Columns of the
input named like those added here give way to them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sentilake.llm.common import with_columns_last
from sentilake.operators.numbering import running_offsets
from sentilake.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """``sizes(source, source_size)`` with weight and target: shares of the budget by
    weight, none above ``max_repeats`` times its source, the excess shared out again.

    One row per source passes through one task.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * float(max_repeats))
    ranked = ranked.withColumn("full_at", F.col("cap") / F.col("weight"))
    order = W.orderBy("full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    left = F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / weight_left)
    # The first source, in order of filling up, that the level does not fill sets the level of all.
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(everything)["level"]
    return ranked.select("source", "source_size", "weight", F.least(F.col("cap"), F.coalesce(
        level * F.col("weight"), F.col("cap"))).alias("target"))


def fair_queue(docs: DataFrame, *, text="text", source="source", id="doc_id", weights=WEIGHTS, share=1.5,
               max_repeats=2, seed=11, rows_per_block=4096) -> DataFrame:
    """Every document with ``size, source_size, target, weight, virtual_finish, copies``.

    ``virtual_finish`` is that of the first copy; copy k of a document follows
    ``k * source_size / weight`` later. Running sums work in two steps: blocks of the
    shuffled order are summed where they are read, their sums add up within a source,
    and only then are the documents of one block sorted. So no task holds a source.
    """
    rows = docs.count()
    blocks = max(1, math.ceil(rows / rows_per_block))
    key = F.xxhash64(F.lit(seed), F.col(id), F.col(text))
    placed = with_columns_last(
        docs, __llm_source=F.col(source).cast("string"), size=word_count(text), __llm_key=key,
        __llm_block=F.floor((key / F.lit(2.0**64) + 0.5) * blocks).cast("long"),
    )
    name = F.struct(F.col("__llm_source").isNull(), F.coalesce("__llm_source", F.lit("")))
    placed = placed.withColumn("__llm_name", name)
    sums = placed.groupBy("__llm_name", "__llm_block").agg(F.sum("size").alias("__llm_words"), F.first("__llm_source").alias("__llm_of"))
    targets = source_targets(
        sums.groupBy(F.col("__llm_of").alias("source")).agg(F.sum("__llm_words").alias("source_size")),
        weights, share, max_repeats,
    )
    earlier = W.partitionBy("__llm_name").orderBy("__llm_block").rowsBetween(W.unboundedPreceding, -1)
    ladder = sums.withColumn("__llm_before", F.coalesce(F.sum("__llm_words").over(earlier), F.lit(0))).join(
        targets, F.col("__llm_of").eqNullSafe(F.col("source"))).select(
        "__llm_name", "__llm_block", "__llm_before", "source_size", "weight", "target")
    own = {"source_size", "weight", "target", "virtual_finish", "copies"}
    placed = placed.drop(*[c for c in placed.columns if c.lower() in own])
    block = W.partitionBy("__llm_name", "__llm_block").orderBy("__llm_key").rowsBetween(W.unboundedPreceding, W.currentRow)
    queued = placed.join(ladder.hint("shuffle_merge"), ["__llm_name", "__llm_block"]).withColumn(
        "__llm_finish", F.col("__llm_before") + F.sum("size").over(block))
    queued = queued.withColumn("virtual_finish", F.col("__llm_finish") / F.col("weight")).drop(
        "__llm_source", "__llm_name", "__llm_block", "__llm_before", "__llm_finish")
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    first_out = _truncate(queued.where("source_size > 0"), max_repeats, budget)
    taken = [F.lit(True) if first_out is None else entry(F.lit(k)) < F.struct(*map(F.lit, first_out)) for k in range(max_repeats)]
    copies = F.when(F.col("source_size") == 0, 0).otherwise(sum((t.cast("int") for t in taken), F.lit(0)))
    return queued.withColumn("copies", copies.cast("int"))


def entry(copy: Column) -> Column:
    """Where a copy of a document stands in the queue: by virtual finish time, less half the
    document's own time, then a hash. So a source is cut at the nearer end of a document."""
    at = F.col("virtual_finish") + (copy * F.col("source_size") - F.col("size") / 2) / F.col("weight")
    return F.struct(at.alias("at"), F.col("__llm_key").alias("key"), copy.alias("copy"))


def _truncate(queued: DataFrame, max_repeats: int, budget: float) -> tuple | None:
    """The first entry that the mix leaves out: all copies of all sources are range-sorted by
    virtual finish time, and their words added up to the budget, file by file and then
    within the file that reaches it. None if the budget takes all."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))
    entries = queued.select("size", "source_size", "weight", "virtual_finish", "__llm_key", copies.alias("copy")).select(
        "size", entry(F.col("copy")).alias("entry"))
    queue = materialize(entries.repartitionByRange("entry").sortWithinPartitions("entry"), "mix_queue").withColumn("file", F.col("_metadata.file_path"))
    files = queue.groupBy("file").agg(F.sum("size").alias("words"), F.min("entry").alias("first"))
    placed = materialize(running_offsets(files, ["first"], "words", "before"), "mix_files")
    here = placed.where(F.col("before") <= budget).orderBy(F.desc("before"), F.desc("first")).first()
    later = placed.where(F.col("before") > budget).agg(F.min("first")).first()[0]
    if here is None:
        return None
    in_order = W.orderBy("entry").rowsBetween(W.unboundedPreceding, W.currentRow)
    middle = F.lit(here.before) + F.sum("size").over(in_order) - F.col("size") / 2
    # One file of the sorted queue, no more than one task wrote.
    out = queue.where(F.col("file") == here.file).withColumn("middle", middle).where(F.col("middle") > budget).agg(F.min("entry")).first()[0]
    found = out or later
    return tuple(found) if found is not None else None


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: whole input rows, one per copy, in order of virtual finish time.

    Adds ``copy`` (from 0) and the ``virtual_finish`` of that copy; the total of the
    words is the budget, up to half a document per source.
    """
    queued = fair_queue(docs, **options).where("copies > 0")
    queued = queued.drop(*[c for c in queued.columns if c.lower() == "copy"])
    copies = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    copies = copies.withColumn("virtual_finish", F.col("virtual_finish") + F.col("copy") * F.col("source_size") / F.col("weight"))
    return copies.orderBy("virtual_finish", "__llm_key").drop("__llm_key", "copies")
