"""Merkle manifest of a dataset by lag/lead windows.

Every row is a leaf: the hash of its fields, each with its length. The leaves of a source
stand in order of their ids. At each level runs of ``FAN`` consecutive nodes become one
node, the hash of their digests, until one is left: the source's root; the source roots
make the dataset's root in the same way. ``H`` is SHA-256 as lower-case hex text.

Levels go up and down by windows over stretches of ``STRETCH`` nodes, so a source of any
size is spread over tasks. Lag and lead columns of fixed offsets 1 to ``FAN - 1``, masked
by a node's slot in its run and by the length of the run, are its siblings; the row of the
first child hashes the parent. On the way down a parent's path comes into the window of
its children as a row just before its first child, and the children take the last one
before them: no level is joined to the next one. Only ids, sources and digests are moved,
texts are read where they lie. Each level above the leaves is a table a sixteenth as long.

Places are counted without a window over a source: rows are range-sorted and written, a
row's place in its file comes from the file's metadata, and only counts by file and
source are summed up.

Rules: NULL fields hash as ``-``. A NULL source is a source of its own and comes first.
Rows of the same id stand in order of their leaves, NULL ids come first; equal rows are
leaves of their own. An empty table has no rows. Only the named columns are read, so
columns of any other name do not matter. A path holds ``FAN - 1`` digests a level at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sentilake.session import materialize

FAN, STRETCH = 16, 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf_of(fields: list[Column]) -> Column:
    """Hash of the fields: ``-`` for NULL, otherwise UTF-8 length, colon, value."""
    as_text = [f.cast("string") for f in fields]
    return digest(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in as_text]))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def source_key(source: Column) -> Column:
    """NULL first, then by code units; never NULL."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos``, the place (from 0) in the node's ``key`` by ``order`` (ascending, NULL first), and
    ``n``, the nodes of the key."""
    written = materialize(nodes.repartitionByRange("key", *order).sortWithinPartitions("key", *order), "merkle_sorted")
    columns = written.columns
    placed = written.withColumns({"__llm_file": F.col("_metadata.file_path"), "__llm_row": F.col("_metadata.row_index")})
    counts = placed.groupBy("key", "__llm_file").agg(
        F.count("*").alias("__llm_n"), F.min("__llm_row").alias("__llm_first"), F.min(F.struct(*order)).alias("__llm_order"))
    by_file = W.partitionBy("key").orderBy("__llm_order")
    starts = counts.select(
        "key", "__llm_file", "__llm_first", F.sum("__llm_n").over(W.partitionBy("key")).alias("n"),
        (F.sum("__llm_n").over(by_file.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__llm_n")).alias("__llm_before"))
    pos = F.col("__llm_before") + F.col("__llm_row") - F.col("__llm_first")
    return placed.join(starts, ["key", "__llm_file"]).select(*columns, pos.alias("pos"), "n")


def siblings(nodes: DataFrame) -> DataFrame:
    """Adds ``left`` and ``right``, the digests before and after a node in its run, joined.

    ``nodes`` have ``key, pos, n, digest``; rows without a digest (paths from above) stand
    before the first node of their run and are not counted.
    """
    stretch = W.partitionBy("key", F.floor(F.col("pos") / STRETCH)).orderBy("pos", F.col("digest").isNotNull())
    slot = F.col("pos") % FAN
    length = F.least(F.lit(FAN), F.col("n") - (F.col("pos") - slot))
    lags = {f"__llm_lag{k}": F.lag("digest", k).over(stretch) for k in range(1, FAN)}
    leads = {f"__llm_lead{k}": F.lead("digest", k).over(stretch) for k in range(1, FAN)}
    extra = {"path": F.last("path", ignorenulls=True).over(stretch.rowsBetween(W.unboundedPreceding, W.currentRow))} if "path" in nodes.columns else {}
    seen = nodes.withColumns(lags | leads | extra)
    left = [F.when(slot >= k, F.col(f"__llm_lag{k}")) for k in range(FAN - 1, 0, -1)]
    right = [F.when(slot + k < length, F.col(f"__llm_lead{k}")) for k in range(1, FAN)]
    return seen.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)}).drop(*lags, *leads)


def parents(nodes: DataFrame) -> DataFrame:
    """The next level; the row of a run's first node hashes it."""
    first = siblings(nodes).where(F.col("pos") % FAN == 0)
    return first.select("key", (F.col("pos") / FAN).cast("long").alias("pos"), F.ceil(F.col("n") / FAN).cast("long").alias("n"),
                        digest(F.concat("digest", "right")).alias("digest"))


def with_paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Adds ``path``, the pairs (left, right) from the node up, of nodes in runs.

    ``above(key, pos, path)`` has the paths of their parents.
    """
    columns = nodes.columns
    given = nodes.withColumn("path", F.lit(None).cast(PATH))
    before = above.select("key", (F.col("pos") * FAN).alias("pos"), "path")
    met = siblings(given.unionByName(before, allowMissingColumns=True)).where("digest is not null")
    own = F.array(F.struct("left", "right"))
    return met.select(*columns, F.concat(own, "path").alias("path"))


def levels(leaves: DataFrame) -> list[DataFrame]:
    """``leaves(key, pos, n, digest)`` and the written levels above, up to one node for every key."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    found = [leaves.select("key", "pos", "n", "digest")]
    while most > 1:
        found.append(materialize(parents(found[-1].where("n > 1")), "merkle_level"))
        most = -(-most // FAN)
    return found


def roots(tree: list[DataFrame]) -> DataFrame:
    """``(key, digest, height)``: the last node of each key."""
    tops = None
    for height, level in enumerate(tree):
        own = level.where("n = 1").select("key", "digest", F.lit(height).alias("height"))
        tops = own if tops is None else tops.union(own)
    return tops


def descend(tree: list[DataFrame], tops: DataFrame, leaves: DataFrame) -> DataFrame:
    """``leaves`` (first level, with further columns) with their ``path``; ``tops(key, height, path)``
    has the paths of the keys' roots."""
    above = None
    for height in range(len(tree) - 1, 0, -1):
        own = tops.where(F.col("height") == height).select("key", F.lit(0).cast("long").alias("pos"), "path")
        if above is not None:
            inner = with_paths(tree[height].where("n > 1"), above).select("key", "pos", "path")
            own = own.union(inner)
        above = materialize(own, "merkle_paths")
    alone = leaves.where("n = 1").join(tops.where("height = 0").select("key", "path"), "key")
    if above is None:
        return alone
    return with_paths(leaves.where("n > 1"), above).unionByName(alone)


def manifest(docs: DataFrame, *, id="doc_id", source="source", fields=FIELDS,
             altered: tuple[Column, dict[str, Column]] | None = None) -> DataFrame:
    """``(id, key, leaf, path, subroot, root, changed)`` of each row.

    ``path`` lists the siblings left and right of the row's node at each level, from the
    leaf to the dataset's root. ``altered`` is a condition on rows and the fields that are
    other ones there; ``changed`` is the leaf with those (NULL for other rows).
    """
    leaf, changed = leaf_of([F.col(f) for f in fields]), F.lit(None).cast("string")
    if altered is not None:
        condition, other = altered
        changed = F.when(condition, leaf_of([other.get(f, F.col(f)) for f in fields]))
    given = docs.select(F.col(id).alias("id"), source_key(F.col(source)).alias("key"), leaf.alias("digest"), changed.alias("changed"))
    leaves = numbered(materialize(given, "merkle_leaves"), ["id", "digest"])
    leaves = materialize(leaves, "merkle_numbered")
    tree = levels(leaves)
    subroots = materialize(roots(tree), "merkle_subroots")
    whole = subroots.select(F.lit("").alias("key"), "digest", "height", F.col("key").alias("source_key"))
    whole = materialize(numbered(whole, ["source_key"]), "merkle_sources")
    upper = levels(whole)
    top = roots(upper)
    crown = top.select("key", "height", F.array().cast(PATH).alias("path"))
    renamed = whole.withColumnRenamed("height", "__llm_height")
    paths = descend(upper, crown, renamed).select(
        F.col("source_key").alias("key"), F.col("__llm_height").alias("height"), "path", F.col("digest").alias("subroot"))
    paths = materialize(paths, "merkle_source_paths")
    # A source's root and the dataset's come down as the ends of the path.
    root = top.select("digest").scalar()
    done = descend(tree, paths.select("key", "height", F.concat(
        "path", F.array(F.struct(F.col("subroot").alias("left"), F.lit("subroot").alias("right")))).alias("path")), leaves)
    end = F.element_at("path", -1)
    return done.select("id", "key", F.col("digest").alias("leaf"), F.slice("path", F.lit(1), F.size("path") - 1).alias("path"),
                       end["left"].alias("subroot"), root.alias("root"), "changed")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))


def proof(path: Column) -> Column:
    """All siblings of a path in order, joined."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")
