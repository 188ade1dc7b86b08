"""Near-duplicate vectors by product quantisation.

Vectors of one label are compared by cosine. A coarse quantiser (k-means) deals unit
vectors to inverted lists; what remains after subtracting the list's centre is coded in
subspaces, one of 256 codewords each. A vector goes to its nearest list and to every
list whose borders with that one, and with the means of the few nearest, are within half
the radius: the list nearest to the middle of two vectors within the radius then holds
them both, so no pair is lost. In a list a query looks the squared distance to each code
up in its table of subspace distances and passes on what may lie within the radius, given
the exact length of the coding error that is stored with each code. What passes is
reranked by the cosine. Two vectors that meet in several lists are linked in the first of
them only, and each link counts at both its ends.

A vector goes to its lists in short, as whole numbers of 16 bits, with a step and the
length of what these leave out; the lists it goes to, as bits, are written with it, once,
and its copies are made on their way to the lists. The short vectors say of nearly every
pair on which side of the limit its cosine is, whatever the rounding. The vectors of the
other pairs are fetched in full, for their list and block, and the cosine in double
precision decides; it would decide the same of every pair.

The number of lists grows with the vectors, one for ``rows_per_list`` of them, up to
one for 16 vectors of the sample. Quantisers are fitted to at most about ``sample_rows``
vectors, chosen by hash; every vector is indexed and is a query.

Equal vectors of a label are one index entry with a count. A list is cut into blocks of
a bounded number of entries, and a task compares two blocks, so a list that holds a
third of all vectors is many tasks of one size. A task reports how many links each
vector has and one edge per vector, not its pairs.

Rules: NULL, empty and zero vectors, vectors with NULL, infinite or NaN components, and
vectors without a label link with nothing. Vectors of different lengths are compared
with those of their own length only. Every row is a vector of its own and gives a row,
also rows that share an id or have none; a component is named by its smallest id, by
NULL when none of its rows has one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sentilake.llm.common import connected_components, slices
from sentilake.session import materialize

ROWS_PER_LIST, SUBSPACES, CODEWORDS = 512, 8, 256
BLOCK = 2048
SLACK = 1e-9
#: Short vectors decide where the squared distance is further than this from the limit's; rounding is below 1e-14.
CLEAR = 4e-12
#: Means of the nearest lists that give borders; numbers of vectors that a task holds in one array for copies and pairs.
MEANS, NUMBERS = 4, 1 << 21
#: Bytes of copies that a task makes, so that it sorts them in memory; more go to disk twice.
TASK = 32 << 20
LINKS = ["key", "partners", "low"]


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first: squares of very large or small ones are not representable.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(rounds):
        at = nearest(x, centres)
        counts = np.bincount(at, minlength=len(centres))
        for j in range(x.shape[1]):
            sums = np.bincount(at, x[:, j], len(centres))
            centres[:, j] = np.where(counts, sums / np.maximum(counts, 1), centres[:, j])
    return centres


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None], 0)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([squared(x[k : k + 4096], centres).argmin(1) for k in range(0, len(x), 4096)] or [np.zeros(0, int)])


class Quantiser:
    """Coarse centres and, for the residuals, codewords of each subspace."""

    def __init__(self, coarse: np.ndarray, books: list[np.ndarray]):
        self.coarse, self.books = coarse, books
        self.bounds = np.cumsum([0, *[b.shape[1] for b in books]])

    @classmethod
    def fit(cls, x: np.ndarray, lists: int, subspaces: int, codewords: int, seed: int) -> Quantiser:
        rng = np.random.default_rng(seed)
        coarse = k_means(x, lists, rng)
        rest = x - coarse[nearest(x, coarse)]
        parts = np.array_split(np.arange(x.shape[1]), min(subspaces, x.shape[1]))
        return cls(coarse, [k_means(rest[:, p], codewords, rng) for p in parts])

    def part(self, x: np.ndarray, j: int) -> np.ndarray:
        return x[..., self.bounds[j] : self.bounds[j + 1]]

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the length of what they leave out."""
        codes = np.stack([nearest(self.part(rest, j), b) for j, b in enumerate(self.books)], 1).astype(np.uint8)
        left = sum(((self.part(rest, j) - b[codes[:, j]]) ** 2).sum(1) for j, b in enumerate(self.books))
        return codes, np.sqrt(left)

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """Squared distance of each query's residual to every codeword, by subspace."""
        return [squared(self.part(q, j), b) for j, b in enumerate(self.books)]

    def probes(self, x: np.ndarray, reach: float) -> np.ndarray:
        """For each vector and list: is it the nearest one, or may a point within reach be nearest to it?

        The squared distance of such a point from it is no more than the mean of those from the nearest
        lists, however many: a border with each of a few means, the first of them the nearest list.
        """
        d, rows = squared(x, self.coarse), np.arange(len(x))
        home, dots = d.argmin(1), self.coarse @ self.coarse.T
        lengths = dots.diagonal()
        inner, own, total = np.zeros_like(d), np.zeros(len(x)), np.zeros(len(x))
        within, nearest_lists = np.ones(d.shape, bool), np.argsort(d, axis=1)[:, :MEANS]
        for t, j in enumerate(nearest_lists.T, 1):
            own += 2 * inner[rows, j] + lengths[j]
            inner += dots[j]
            total += d[rows, j]
            apart = np.sqrt(np.maximum(lengths - 2 * inner / t + (own / t**2)[:, None], 0))
            # Rounded so that no list is left out.
            within &= d - (total / t)[:, None] <= 2 * reach * (apart + 1e-7) + 1e-12
        return within | (np.arange(len(self.coarse)) == home[:, None])


def shorten(x: np.ndarray) -> np.ndarray:
    """Vectors as whole numbers of steps, and the length of what these leave out, rounded up."""
    made = np.zeros(len(x), short_form(x.shape[1]))
    made["step"] = np.abs(x).max(axis=1) / 32767
    step = made["step"].astype(np.float64)[:, None]
    made["whole"] = np.rint(x / step)
    made["left"] = up(np.sqrt(((x - made["whole"] * step) ** 2).sum(1)))
    return made


def up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def short_form(width: int, *more) -> np.dtype:
    return np.dtype([("step", "<f4"), ("left", "<f4"), ("whole", "<i2", (width,)), *more])


def binary(cells: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The first bytes of each row of a matrix of bytes."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    kept = cells[np.arange(cells.shape[1]) < lengths[:, None]]
    return pa.Array.from_buffers(pa.binary(), len(cells), [None, pa.py_buffer(ends), pa.py_buffer(kept)])


def raw(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)


def records(column: pa.ChunkedArray | pa.Array, form: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), form)


def flat(roots: np.ndarray) -> np.ndarray:
    """Points every entry of a forest at its root, in place."""
    while (roots[roots] != roots).any():
        roots[:] = roots[roots]
    return roots


def near_vectors(vectors: DataFrame, *, id="vec_id", vector="embedding", label="label", least: float = 0.98,
                 lists: int | None = None, rows_per_list: int = ROWS_PER_LIST, subspaces: int = SUBSPACES,
                 sample_rows: int = 16384, block: int = BLOCK, seed: int = 3) -> DataFrame:
    """``(id, n_links, component_id)`` of every row."""
    radius = float(np.sqrt(2 - 2 * least))
    kind = vectors.schema[vector].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
                          F.col(vector).cast(kind).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0)
    rows = materialize(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    good = rows.where("sound")
    # One index entry for equal vectors.
    entries = good.groupBy("label", "v").agg(F.min("id").alias("low_id"), F.count("*").alias("n"))
    entries = materialize(entries.withColumns({"width": F.size("v"), "key": F.monotonically_increasing_id()}), "entries")
    links = None
    for width, n in sorted(tuple(r) for r in entries.groupBy("width").count().collect()):
        k = lists or max(1, min(n // rows_per_list, sample_rows // 16))
        found = materialize(_search(entries.where(F.col("width") == width), n, radius, least, k, subspaces,
                                    sample_rows, block, seed), "pq_links")
        links = found if links is None else links.union(found)
    if links is None:
        links = entries.select("key", F.lit(0).cast("long").alias("partners"), F.col("key").alias("low"))
    classes = materialize(connected_components(links.select(F.col("key").alias("a"), F.col("low").alias("b"))), "classes")
    classes = classes.withColumnRenamed("node", "key")
    lowest = entries.join(classes, "key").groupBy("component").agg(F.min("low_id").alias("component_id"))
    partners = links.groupBy("key").agg(F.sum("partners").alias("partners"))
    entry = entries.join(partners, "key", "left").join(classes.join(lowest, "component"), "key", "left").select(
        "label", "v", (F.coalesce("partners", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component_id", "low_id").alias("component_id"))
    return good.join(entry, ["label", "v"]).select("id", "n_links", "component_id").union(
        rows.where("not sound").select("id", F.lit(0).cast("long"), "id"))


def _search(entries, n, radius, least, lists, subspaces, sample_rows, block, seed) -> DataFrame:
    """``(key, partners, low)`` rows: for each entry and block the links found, and an entry it is linked with."""
    chosen = entries.where(F.xxhash64(F.lit(seed), "v") / F.lit(2.0**64) + 0.5 < F.lit(min(1.0, sample_rows / n) + 1e-12))
    quantiser = Quantiser.fit(unit(matrix(chosen.select("v").toArrow().column(0))), lists, subspaces, CODEWORDS, seed)
    if not len(quantiser.coarse):
        quantiser = Quantiser.fit(unit(matrix(entries.select("v").limit(1).toArrow().column(0))), 1, 1, 1, seed)
    width, coded = quantiser.coarse.shape[1], [("error", "<f4"), ("codes", "u1", (len(quantiser.books),))]
    at_once = max(1, NUMBERS // width)
    shared = entries.sparkSession.sparkContext.broadcast((quantiser.coarse, quantiser.books))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Quantiser(*shared.value)
        for part in slices(batches, 1024):
            if part.num_rows:
                x = unit(matrix(part.column(3)))
                seen = np.packbits(own.probes(x, radius / 2 + SLACK), axis=1)
                packed = [binary(rows, np.full(len(rows), rows.shape[1])) for rows in (raw(shorten(x)), seen)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *packed], names=["label", "key", "n", "short", "seen"])

    def visited_lists(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of vectors and the lists they go to."""
        return np.nonzero(np.unpackbits(seen, axis=1))

    def lists_of(column: pa.Array) -> np.ndarray:
        return records(column, np.dtype("u1")).reshape(len(column), -1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1024):
            if part.num_rows:
                which, at = visited_lists(lists_of(part.column(1)))
                pairs = pa.table({"label": part.column(0).take(pa.array(which)), "list": pa.array(at.astype(np.int32))})
                found = pairs.group_by(["label", "list"]).aggregate([([], "count_all")])
                yield from found.select(["label", "list", "count_all"]).rename_columns(["label", "list", "members"]).to_batches()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Quantiser(*shared.value)
        for part in slices(batches, 1024):
            if not part.num_rows:
                continue
            rows, seen = records(part.column(3), short_form(width)), lists_of(part.column(4))
            x = rows["whole"] * rows["step"].astype(np.float64)[:, None]
            all_which, all_at = visited_lists(seen)
            for k in range(0, len(all_at), at_once):
                which, at = all_which[k : k + at_once], all_at[k : k + at_once]
                codes, error = own.encode(x[which] - own.coarse[at])
                body = np.zeros(len(at), short_form(width, *coded))
                for name in ("step", "left", "whole"):
                    body[name] = rows[name][which]
                body["codes"], body["error"] = codes, up(error)
                # Of the lists, those up to this one.
                packed = binary(np.hstack([raw(body), seen[which]]), body.itemsize + at // 8 + 1)
                copies = part.select([0, 1, 2]).take(pa.array(which))
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *copies.columns, packed],
                                                 names=["list", "label", "key", "n", "body"])

    # Written once for each vector; its copies, one a list, only go to their tasks.
    visited = materialize(entries.select("label", "key", "n", "v").mapInArrow(
        visit, "label string, key long, n long, short binary, seen binary"), "visited")
    members = visited.select("label", "seen").mapInArrow(count, "label string, list int, members long")
    counts = materialize(members.groupBy("label", "list").agg(F.sum("members").alias("members")).where("members > 1").select(
        "label", "list", "members", F.ceil(F.col("members") / block).cast("int").alias("blocks")), "lists")
    copies = counts.agg(F.sum(F.col("members") * F.col("blocks"))).first()[0] or 0
    tasks = copies * (2 * width + 256) // TASK
    spread = visited.repartition(tasks, "key") if tasks > visited.rdd.getNumPartitions() else visited
    dealt = spread.mapInArrow(deal, "list int, label string, key long, n long, body binary")
    placed = dealt.join(counts, ["label", "list"]).withColumn(
        "own", F.pmod(F.xxhash64(F.lit(seed), "key"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumn("c", F.greatest("own", "other")).withColumn("q", F.least("own", "other"))

    pair, placing = ["label", "list", "c", "q"], ["list", "label", "n", "body", "own", "c", "q"]

    def scan(group: pa.Table) -> pa.Table:
        """Links of two blocks; with vectors in full, those among pairs on which short ones do not decide."""
        quantiser = Quantiser(*shared.value)
        keys, n, own = (np.asarray(group.column(c)) for c in ("key", "n", "own"))
        at, c, q = (group.column(name)[0].as_py() for name in ("list", "c", "q"))
        body = records(group.column("body"), short_form(width, *coded, ("seen", "u1", (at // 8 + 1,))))
        step, left, error = (body[name].astype(np.float64) for name in ("step", "left", "error"))
        whole, codes, seen = body["whole"].astype(np.float64), body["codes"], body["seen"]
        norms = step * step * (whole * whole).sum(1)
        full = unit(matrix(group.column("v"))) if "v" in group.column_names else None
        # Bits of the lists before this one: who shares one of them has met there.
        earlier = np.packbits(np.arange(8 * seen.shape[1]) < at)
        asks, answers = np.flatnonzero(own == q), np.flatnonzero(own == c)
        partners, unsettled = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        roots = np.arange(len(keys))  # links inside this task, as a forest

        def root(i):
            while roots[i] != i:
                roots[i] = roots[roots[i]]
                i = roots[i]
            return i

        for k in range(0, len(asks), 256):
            some = asks[k : k + 256]
            against = answers[k:] if c == q else answers
            distance = np.zeros((len(some), len(against)))
            for j, table in enumerate(quantiser.tables(whole[some] * step[some, None] - quantiser.coarse[at])):
                distance += table[:, codes[against, j]]
            # |q - x| >= |q - code| - error: nothing within the radius is passed over.
            near = np.sqrt(np.maximum(distance, 0)) <= radius + 1e-6 + (error + left)[against][None, :] + left[some][:, None]
            if c == q:
                near &= some[:, None] < against[None, :]
            a, b = np.nonzero(near)
            for m in range(0, len(a), at_once):
                i, j = some[a[m : m + at_once]], against[b[m : m + at_once]]
                # Sums of whole numbers are exact, so both passes find the same pairs undecided.
                apart = np.sqrt(np.maximum(norms[i] + norms[j] - 2 * (step[i] * step[j] * (whole[i] * whole[j]).sum(1)), 0))
                blur = left[i] + left[j]
                linked = (apart + blur) ** 2 <= radius * radius - CLEAR
                unsure = ~linked & (np.maximum(apart - blur, 0) ** 2 <= radius * radius + CLEAR)
                keep = (linked | unsure) if full is None else unsure
                i, j, unsure = i[keep], j[keep], unsure[keep]
                first = ~(seen[i] & seen[j] & earlier).any(1)
                i, j, unsure = i[first], j[first], unsure[first]
                if full is None:
                    unsettled[i[unsure]] = unsettled[j[unsure]] = True
                    linked = ~unsure
                else:
                    linked = (full[i] * full[j]).sum(1) >= least
                i, j = i[linked], j[linked]
                np.add.at(partners, i, n[j])
                np.add.at(partners, j, n[i])
                s, t = flat(roots)[i], roots[j]
                new = np.unique(np.stack([s, t], 1)[s != t], axis=0)
                for s, t in new.tolist():
                    s, t = root(s), root(t)
                    roots[max(s, t)] = min(s, t)
        heads, low = flat(roots), keys.copy()
        np.minimum.at(low, heads, keys)
        keep = partners > 0
        found = pa.table({"key": keys[keep], "partners": partners[keep], "low": low[heads][keep]})
        if full is None:
            found = pa.concat_tables([found, group.filter(pa.array(unsettled))], promote_options="default")
        return found.select(LINKS if full is not None else LINKS + placing)

    found = materialize(placed.select("key", *placing).groupBy(pair).applyInArrow(
        scan, "key long, partners long, low long, list int, label string, n long, body binary, own int, c int, q int"), "pq_blocks")
    links, undecided = found.where("partners is not null").select(LINKS), found.where("partners is null").select("key", *placing)
    if undecided.isEmpty():
        return links
    return links.union(undecided.join(entries.select("key", "v"), "key").groupBy(pair).applyInArrow(
        scan, "key long, partners long, low long"))
