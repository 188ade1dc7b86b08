"""Near-duplicate documents by MinHash.

A document's shingles are its distinct runs of five words; its signature holds the
minima of many universal hashes (``a * x + b``, top half) over them. Bands of minima
that agree make two documents meet in a bucket. What meets is checked: first on the
signatures, then on the full shingle sets. Links make classes, by large-star and
small-star.

No bucket is expanded into all its pairs. Equal texts are one class member from the
start. In a bucket, every member is checked against one hub only, the member whose
buckets are largest, which for copies of one text is that text. Only where that leaves
a bucket in several classes are members of different classes compared, by signature and
by shingles, in bounded blocks that report links only. So a pair is left out only if its
members are in one class already.

Rules: NULL and empty texts, and texts without words, have no shingles and no links; a
text of fewer words than a shingle has one, the whole. Rows that share an id, or have none,
are documents of their own as far as their texts differ. 64-bit hashes
stand for shingles in the counts and signatures; the check of a pair compares words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sentilake.llm.common import connected_components, mix64, words
from sentilake.llm.merkle import numbered
from sentilake.session import materialize

SHINGLE = 5
BLOCK = 512
#: Standard deviations of a signature's estimate that the first check allows for.
SLACK = 4.5


def hash_words(tokens: list[bytes], cache: dict[bytes, int]) -> np.ndarray:
    if len(cache) > 1 << 20:
        cache.clear()
    for w in set(tokens).difference(cache):
        cache[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    return np.fromiter(map(cache.__getitem__, tokens), np.uint64, len(tokens))


def shingle_hashes(tokens: list[bytes], cache: dict[bytes, int], n: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit shingle hashes, sorted."""
    h = hash_words(tokens, cache)
    if len(h) == 0:
        return h
    size = min(n, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)]
    return np.unique(mix64(out))


def shingle_set(tokens: list[bytes], n: int = SHINGLE) -> set:
    if len(tokens) < n:
        return {tuple(tokens)} if tokens else set()
    return set(zip(*[tokens[k:] for k in range(n)]))


def coefficients(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, size, dtype=np.uint64)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 2048):
        x = shingles[k : k + 2048]
        np.minimum(low, (a[:, None] * x + b[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def versions(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))


def signatures(docs: DataFrame, id: str, text: str, bands: int, rows: int, seed: int, n: int) -> DataFrame:
    """``(id, version, digest, n_shingles, keys, marks)``: band keys, and a byte of each minimum."""
    a, b = coefficients(bands * rows, seed)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        weights = mix64(np.arange(1, rows + 1, dtype=np.uint64))
        for batch in batches:
            ids, digests, sizes, keys, marks = batch.column(0), [], [], [], []
            for t in batch.column(2).to_pylist():
                tokens = words(t)
                digests.append(hashlib.blake2b(b" ".join(tokens), digest_size=16).digest())
                shingles = shingle_hashes(tokens, cache, n)
                sizes.append(len(shingles))
                if not len(shingles):
                    keys.append(None), marks.append(None)
                    continue
                low = minima(shingles, a, b)
                band = (low.reshape(bands, rows).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
                keys.append(mix64(band + np.arange(bands, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)).astype(np.int64))
                marks.append(low.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column(1), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                names=["id", "version", "digest", "n_shingles", "keys", "marks"])

    given = versions(docs, id, text)
    return given.mapInArrow(
        sign, f"id {given.schema['id'].dataType.simpleString()}, version long, digest binary, n_shingles long, keys array<long>, marks binary")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, n: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full shingle sets reach the similarity: 100 * common >= percent * union."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            good = []
            hubs, others = batch.column(2), batch.column(3)
            for i, hub in enumerate(batch.column(0).to_pylist()):
                if hub != last:
                    last, own = hub, shingle_set(words(hubs[i].as_py()), n)
                other = shingle_set(words(others[i].as_py()), n)
                common = len(own & other)
                good.append(100 * common >= percent * (len(own) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # Both sides of either join can be split where one document has very many partners.
    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    with_a = with_b.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return with_a.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def alike(x: DataFrame, least: int) -> DataFrame:
    """Of rows with ``marks`` and ``marks_b``, those whose signatures agree in ``least`` places."""
    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            o = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            yield batch.select(["a", "b"]).filter(pa.array((m == o).sum(axis=1) >= least))

    return x.select("a", "b", "marks", "marks_b").mapInArrow(agree, "a long, b long")


def cross_class_links(members: DataFrame, least: int, percent: int, n: int) -> DataFrame:
    """Links between members of different classes: of ``(key, id, class, marks, keys, text)``.

    A bucket is cut into blocks by a hash of the id, and a task compares two blocks, so
    memory is bounded whatever the bucket. A pair is compared in the first bucket of all
    that it shares, by signature and then by shingles, unless links found before put it
    in one class. Only those links come out, fewer than there are members.
    """
    counts = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    with_later = F.transform(F.sequence("block", F.col("blocks") - 1), lambda o: F.struct(F.col("block").alias("one"), o.alias("two")))
    with_earlier = F.transform(F.sequence(F.lit(0), F.col("block")), lambda o: F.struct(o.alias("one"), F.col("block").alias("two")))
    both = placed.withColumn("pair", F.explode(F.array_distinct(F.concat(with_later, with_earlier))))

    def compare(group: pa.Table) -> pa.Table:
        cache: dict[bytes, int] = {}
        key, two = group.column("key")[0].as_py(), group.column("two")[0].as_py()
        ids, block = np.asarray(group.column("id")), np.asarray(group.column("block"))
        marks = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint8).reshape(len(ids), -1)
        lists = group.column("keys").to_pylist()
        kept = np.full((len(ids), max(map(len, lists))), np.iinfo(np.int64).max)
        for r, ks in enumerate(lists):
            kept[r, : len(ks)] = ks
        classes, own = np.unique(np.asarray(group.column("class")), return_inverse=True)
        root = own.copy()
        sets: dict[int, np.ndarray] = {}

        def shingles(r: int) -> np.ndarray:
            if r not in sets:
                sets[r] = shingle_hashes(words(group.column("text")[r].as_py()), cache, n)
            return sets[r]

        left = np.flatnonzero(block == group.column("one")[0].as_py())
        right = np.flatnonzero(block == two)
        same = len(left) == len(ids)
        a, b = [], []
        for i in left.tolist():
            js = right[root[right] != root[i]]
            js = js[ids[js] > ids[i]] if same else js
            agree = (marks[js] == marks[i]).sum(axis=1)
            js, agree = js[agree >= least], agree[agree >= least]
            shared = np.where(np.isin(kept[js], kept[i]), kept[js], np.iinfo(np.int64).max)
            go = shared.min(axis=1, initial=np.iinfo(np.int64).max) == key
            for j in js[go][np.argsort(-agree[go], kind="stable")].tolist():
                if root[j] == root[i]:
                    continue
                x, y = shingles(i), shingles(j)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    a.append(ids[i]), b.append(ids[j])
                    root[root == root[j]] = root[i]
        return pa.table({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    both = both.select("key", F.col("pair.one").alias("one"), F.col("pair.two").alias("two"), "block", "id", "class", "marks", "keys", "text")
    return both.groupBy("key", "one", "two").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, id="doc_id", text="text", percent: int = 80, bands: int = 24, rows: int = 4,
                    seed: int = 7, shingle: int = SHINGLE) -> DataFrame:
    """``(id, version, n_shingles, component_id, row, component_row, copies)`` of every
    different pair of id and text; version: the text's hash; component: the smallest id of
    the class (NULL is the greatest); copies: rows of the pair. Rows are numbered by id, so
    ids of any type, shared ones and NULL are told apart.

    At a similarity of 0.8 a pair misses all of 24 bands of 4 minima in about 3 of a
    million cases, at 0.85 in one of 50 million.
    """
    share = percent / 100
    size = bands * rows
    least = int(size * share - SLACK * (size * share * (1 - share)) ** 0.5)
    signed = materialize(signatures(docs, id, text, bands, rows, seed, shingle), "signatures")
    pairs = signed.groupBy("id", "version", "digest").agg(
        F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n_shingles", "keys", "marks")])
    placed = numbered(pairs.withColumns({"key": F.lit(""), "none": F.col("id").isNull()}), ["none", "id", "version", "digest"])
    own = materialize(placed.select(F.col("pos").alias("id"), F.col("id").alias("doc"), "version", "digest", "copies", "n_shingles", "keys", "marks"), "numbered")
    # One representative for each different text.
    rep = F.min(F.struct("id", "doc", "version", "keys", "marks"))
    reps = own.where("n_shingles > 0").groupBy("digest").agg(rep.alias("r")).select("digest", "r.*")
    reps = materialize(reps, "representatives")

    met = reps.select("id", F.explode("keys").alias("key"))
    shared = met.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    # Buckets with the same members are one bucket.
    shared = shared.where("size > 1").groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key", "size")
    bucketed = materialize(met.join(shared, "key"), "buckets")
    weight = bucketed.groupBy("id").agg(F.sum("size").alias("weight"))
    hubs = bucketed.join(weight, "id").groupBy("key").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("hub"))
    pairs = bucketed.join(hubs, "key").where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    marks = reps.select("id", "marks")
    tested = alike(
        pairs.join(marks.withColumnRenamed("id", "b").withColumnRenamed("marks", "marks_b"), "b")
        .join(marks.withColumnRenamed("id", "a"), "a"), least)
    wanted = reps.join(bucketed, "id", "left_semi").select("id", "doc", F.col("version").alias("wanted"))
    given = versions(docs, id, text).withColumnRenamed("id", "given")
    texts = given.join(wanted, F.col("given").eqNullSafe(F.col("doc")) & (F.col("version") == F.col("wanted"))).dropDuplicates(["id"])
    texts = materialize(texts.select("id", "text"), "bucket_texts")
    links = materialize(confirm(tested, texts, percent, shingle), "links")

    classes = connected_components(links)
    classed = bucketed.select("id", "key").join(classes.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "key", F.coalesce("component", "id").alias("class"))
    open_keys = classed.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("key")
    members = materialize(classed.join(open_keys, "key"), "open_buckets")
    own_keys = members.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    known = own_keys.join(marks, "id").join(texts, "id")
    rest = cross_class_links(members.join(known, "id"), least, percent, shingle)
    more = materialize(confirm(rest, texts, percent, shingle), "links")
    if not more.isEmpty():
        classes = connected_components(links.union(more))

    of_text = reps.select("id", "digest").join(classes.withColumnRenamed("node", "id"), "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component_row"))
    named = of_text.join(reps.select(F.col("id").alias("component_row"), F.col("doc").alias("component_doc")), "component_row")
    linked = F.col("n_shingles") > 0
    return own.join(named, "digest", "left").select(
        F.col("doc").alias("id"), "version", "n_shingles", F.when(linked, F.col("component_doc")).otherwise(F.col("doc")).alias("component_id"),
        F.col("id").alias("row"), F.when(linked, F.col("component_row")).otherwise(F.col("id")).alias("component_row"), "copies")


def keep_one(docs: DataFrame, *, id="doc_id", text="text", **options) -> DataFrame:
    """Rows of ``docs`` with one document of each class, the one with the smallest id.

    Rows that share an id are told apart by their texts. Rows without words are linked with
    nothing and all stay.
    """
    kept = near_duplicates(docs, id=id, text=text, **options).where("row = component_row")
    keys = kept.select(F.col("id").alias("__llm_id"), F.col("version").alias("__llm_version"), (F.col("n_shingles") > 0).alias("__llm_linked"))
    given = docs.withColumn("__llm_text", F.xxhash64(text))
    met = given.join(keys, F.col(f"`{id}`").eqNullSafe(F.col("__llm_id")) & (F.col("__llm_text") == F.col("__llm_version")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = met.where("__llm_linked").dropDuplicates(["__llm_id", "__llm_version"]).select(*columns)
    return one.union(met.where("not __llm_linked").select(*columns))
