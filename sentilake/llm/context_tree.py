"""Language-model scores by context-tree weighting over bytes.

A text is its lower-cased words (A-Z only) joined by one space, and an end byte. A byte
is eight binary decisions; the decisions already made, with the bytes before it, are
the context. Every context of 0 to ``depth`` bytes has a Krichevsky-Trofimov estimate
from the decisions seen there in training. A context's estimate and the product of what
the contexts one byte longer give are mixed with equal weight, at every depth; the
weights that this leaves after training mix the predictions for a byte. Where training
has seen nothing a decision costs one bit.

No count is left out, and what is broadcast has a fixed size. A first pass counts the
distinct runs of ``depth + 1`` bytes of each task, with counts from training documents
(0 for runs that only others have); counts are added up by run; the tree is built below
each ending of two bytes by one task each, which gives every run its probability; the
two shortest depths are bounded tables. For scoring, documents are dealt to parts of
about ``part_bytes``, as compressed blocks. The ``table_size`` values that most tasks
need go to every worker; a part asks for the others by key, and scores its documents
when the answers have come. Counts of words for the base score take the same way, under
64-bit hashes.

Rules: NULL counts as empty: the end alone. A NULL id belongs to the fold of the text
"None". Repeated rows are scored, and learnt from, each. Without any training document
all decisions cost one bit.
"""

from __future__ import annotations

import collections
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from sentilake.llm.common import SortedHashes, fold, mix64, slices, words
from sentilake.session import materialize

DEPTH, END = 5, 0
#: Unit of the probabilities that are kept and sent: a millionth of a decimal digit.
SCALE = 1e6
STEP = 1 << 20
#: Runs from which a block of the tree is built by itself; the runs of one third byte stay together.
BLOCK = 1 << 15


def stream(tokens: list[bytes]) -> bytes:
    return b" ".join(tokens) + bytes([END])


def text_runs(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The run of ``depth + 1`` bytes that ends at each byte of each text (padded in
    front with end bytes), and the number of runs of each text."""
    pad = bytes([END]) * depth
    # Eight bytes from each place on, read as a number; a run is the first ``depth + 1`` of them.
    data = b"".join(x for t in texts for x in (pad, t)) + bytes(8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(size + depth)])
    out = np.ndarray((starts[-1],), ">u8", data, strides=(1,)).astype(np.uint64)
    out >>= np.uint64(8 * (7 - depth))
    keep = np.ones(len(out), bool)
    for back in range(1, depth + 1):
        keep[starts[1:] - back] = False
    return out[keep], size


def in_steps(texts: list[bytes]) -> Iterator[list[int]]:
    """Places of consecutive texts, together about ``STEP`` bytes."""
    part, size = [], 0
    for i, t in enumerate(texts):
        part.append(i)
        size += len(t)
        if size >= STEP:
            yield part
            part, size = [], 0
    if part:
        yield part


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.concatenate(keys)
    order = np.argsort(key)
    key, n = key[order], np.concatenate(counts)[order].astype(np.int64)
    heads = np.flatnonzero(np.concatenate([key[:1] == key[:1], key[1:] != key[:-1]]))
    return key[heads], np.add.reduceat(n, heads) if len(heads) else n


def count_part(texts: list[bytes], learn: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of some texts, and how often the texts to learn from have them."""
    keys, counts = [], []
    for used in (True, False):
        own = [texts[i] for i in np.flatnonzero(learn == used)]
        for part in in_steps(own):
            key, n = np.unique(text_runs([own[i] for i in part], depth)[0], return_counts=True)
            keys.append(key), counts.append(n * used)
            if len(keys) > 16:
                key, n = merged(keys, counts)
                keys, counts = [key], [n]
    return merged(keys, counts)


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) | (1 << 63)


END_KEY = word_key(b"\n")  # no word holds white space


# The tree

def log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 7.0
    s = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    for k in range(7):
        s -= np.log(x + k)
    return s


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that Krichevsky-Trofimov gives to so many decisions, in any order."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def decisions(contexts: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes ``context << 8 | decided`` of the eight decisions of each byte, and the decisions."""
    nodes, ones = [], []
    for i in range(8):
        nodes.append((contexts << np.uint64(8)) | (np.uint64(1) << np.uint64(i)) | (byte >> np.uint64(8 - i)))
        ones.append((byte >> np.uint64(7 - i)) & np.uint64(1))
    return np.concatenate(nodes), np.concatenate(ones).astype(np.float64)


def shorter(nodes: np.ndarray, depth: int) -> np.ndarray:
    """The node of each, with a context of ``depth`` bytes: the oldest go."""
    mask = np.uint64((1 << (8 * depth)) - 1)
    return (((nodes >> np.uint64(8)) & mask) << np.uint64(8)) | (nodes & np.uint64(255))


def level(nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
    """Sums by node: (node, zeros, ones, log weighted probability, weight of the own estimate)."""
    node, at = np.unique(nodes, return_inverse=True)
    z, o = np.bincount(at, zeros, len(node)), np.bincount(at, ones, len(node))
    own = log_kt(z, o)
    if below is None:
        return node, z, o, own, np.ones(len(node))
    product = np.bincount(at, below, len(node))
    mixed = np.logaddexp(own, product) - math.log(2)
    return node, z, o, mixed, np.exp(own - math.log(2) - mixed)


def build(runs: np.ndarray, counts: np.ndarray, depth: int, top: int):
    """Levels from ``depth`` up to ``top`` of the tree over some runs."""
    nodes, ones = decisions(runs >> np.uint64(8), runs & np.uint64(255))
    n = np.tile(counts.astype(np.float64), 8)
    levels = {depth: level(nodes, n * (1 - ones), n * ones, None)}
    for d in range(depth - 1, top - 1, -1):
        node, z, o, below, _ = levels[d + 1]
        levels[d] = level(shorter(node, d), z, o, below)
    return levels


def blocks(runs: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the runs by the third byte before the last: runs with the same one stay together."""
    third = (runs >> np.uint64(24)) & np.uint64(255)
    order = np.argsort(third, kind="stable")
    ends = np.cumsum(np.bincount(third.astype(np.int64), minlength=256))
    start = 0
    for end in ends:
        if end - start >= BLOCK or (end == len(runs) and end > start):
            yield order[start:end]
            start = end


def sums_of_two(runs: np.ndarray, counts: np.ndarray, depth: int, p_one: np.ndarray | None = None):
    """``(node, zeros, ones, log probability of what is below)`` of the contexts of two bytes, from
    trees of a block each below the level of three. ``p_one`` (8 x runs) gets the
    probabilities that the longer contexts give."""
    threes = []
    for at in blocks(runs):
        n = counts[at]
        if (n > 0).any():
            levels = build(runs[at][n > 0], n[n > 0], depth, 3)
            threes.append(levels[3][:4])
            if p_one is not None:
                p_one[:, at] = mix(levels, runs[at], range(depth, 2, -1), p_one[:, at].ravel()).reshape(8, -1)
    if not threes:
        return [np.zeros(0)] * 4
    node, z, o, below = (np.concatenate(x) for x in zip(*threes))
    short, at = np.unique(shorter(node, 2), return_inverse=True)
    return short, *(np.bincount(at, x, len(short)) for x in (z, o, below))


def mix(levels: dict, runs: np.ndarray, depths: range, p_one: np.ndarray) -> np.ndarray:
    """Carries the probability of "one" for each decision of each run (8 x runs) up through ``depths``."""
    nodes, _ = decisions(runs >> np.uint64(8), runs & np.uint64(255))
    for d in depths:
        node, z, o, _, weight = levels[d]
        at = np.searchsorted(node, shorter(nodes, d))
        at = np.minimum(at, len(node) - 1)
        hit = node[at] == shorter(nodes, d)
        own = (o[at] + 0.5) / (z[at] + o[at] + 1)
        p_one = np.where(hit, weight[at] * own + (1 - weight[at]) * p_one, p_one)
    return p_one


def log10_of(runs: np.ndarray, p_one: np.ndarray) -> np.ndarray:
    _, ones = decisions(runs >> np.uint64(8), runs & np.uint64(255))
    return np.log10(np.where(ones == 1, p_one, 1 - p_one)).reshape(8, -1).sum(0)


def score_documents(docs: DataFrame, *, id="doc_id", text="text", folds: int = 7, held_fold: int = 2, depth: int = DEPTH,
                    part_bytes: int = 5 << 20, table_size: int = 1 << 20, seed: int = 19) -> tuple[DataFrame, DataFrame]:
    """``(id, held_out, n_bytes, n_tokens, n_known, sum_log10_count, score)`` of each document,
    and the values that ``base_scores`` needs.

    ``score`` is the log10 probability of the text; bits per byte are
    ``-score / n_bytes / log10(2)``. ``sum_log10_count`` is the sum over tokens of
    log10(count in training + 1).
    """
    if not 2 < depth < 7:
        raise ValueError("depth is from 3 to 6 bytes")
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, math.ceil(total / part_bytes))
    given = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    learnt = lambda ids: np.array([fold(i, folds) != held_fold for i in ids], bool)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for batch in slices(batches, 1024):
            learn = learnt(batch.column(0).to_pylist())
            tokens = [words(t) for t in batch.column(1).to_pylist()]
            for key, n in (count_part([stream(t) for t in tokens], learn, depth), count_words(tokens, learn)):
                keys.append(key), counts.append(n)
                size += len(key)
            if size > 3 << 19:
                key, n = merged(keys, counts)
                keys, counts, size = [key], [n], len(key)
                if size > 1 << 20:
                    yield pa.RecordBatch.from_pydict({"key": key.astype(np.int64), "n": n})
                    keys, counts, size = [], [], 0
        key, n = merged(keys, counts)
        yield pa.RecordBatch.from_pydict({"key": key.astype(np.int64), "n": n})

    counted = given.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("asked"))
    counted = materialize(counted, "runs_counted")
    values = _probabilities(counted.where("key >= 0"), depth).union(
        counted.where("key < 0").select("key", F.col("n").alias("value"), "asked"))
    values = materialize(values, "run_values")
    shared = docs.sparkSession.sparkContext.broadcast({"common": _common(values, table_size)})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            rows = collections.defaultdict(lambda: ([], [], []))
            for piece in slices([batch]):
                for part, i, t in zip(*(piece.column(k).to_pylist() for k in range(3))):
                    ids, sizes, texts = rows[part]
                    texts.append(stream(words(t)))
                    ids.append(i), sizes.append(len(texts[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int32()), pa.array([r[0] for r in rows.values()], pa.list_(batch.column(1).type)),
                 pa.array([r[1] for r in rows.values()], pa.list_(pa.int64())),
                 pa.array([press.compress(b"".join(r[2])) for r in rows.values()], pa.binary())], names=["part", "ids", "sizes", "block"])

    part = F.pmod(F.xxhash64(F.lit(seed), "id", "text"), F.lit(parts)).cast("int")
    dealt = given.select(part.alias("part"), "id", "text").mapInArrow(deal, f"part int, ids array<{kind}>, sizes array<long>, block binary")

    def unpacked(group: pa.Table) -> tuple[list, list[bytes]]:
        texts = []
        for sizes, block in zip(group.column("sizes").to_pylist(), group.column("block").to_pylist()):
            data, at = zstandard.ZstdDecompressor().decompress(block, max_output_size=sum(sizes)), 0
            for size in sizes:
                texts.append(data[at : at + size])
                at += size
        return [i for ids in group.column("ids").to_pylist() for i in ids], texts

    def ask(group: pa.Table) -> pa.Table:
        _, texts = unpacked(group)
        common, rare = Values.shared(shared.value), []
        for part in in_steps(texts):
            runs, _ = text_runs([texts[i] for i in part], depth)
            rare.append(np.unique(runs[common.places(runs) < 0]))
        words_here = word_keys(distinct_words(texts))
        keys = np.concatenate([np.unique(np.concatenate(rare)) if rare else np.zeros(0, np.uint64), words_here[common.places(words_here) < 0]])
        return pa.table({"part": np.full(len(keys), group.column("part")[0].as_py(), np.int32), "key": keys.astype(np.int64)})

    asked = dealt.groupBy("part").applyInArrow(ask, "part int, key long")
    answers = asked.join(values.select("key", "value").hint("shuffle_hash"), "key").select("part", "key", "value")

    def score(group: pa.Table, answers: pa.Table) -> pa.Table:
        common = Values.shared(shared.value)
        own = Values(*in_order(np.asarray(answers.column("key")).astype(np.uint64), np.asarray(answers.column("value"))))
        ids, texts = unpacked(group)
        n, result = len(texts), np.zeros(len(texts))
        for part in in_steps(texts):
            runs, size = text_runs([texts[i] for i in part], depth)
            # Every text has at least the run of its end.
            result[part] = np.add.reduceat(looked_up(common, own, runs), np.cumsum(size) - size) / -SCALE
        distinct = distinct_words(texts)
        count_of = looked_up(common, own, word_keys(distinct))
        logs_of = dict(zip(distinct, np.log10(count_of + 1.0).tolist()))
        end = math.log10(count_of[-1] + 1.0)
        n_words = np.array([t.count(b" ") + 1 if len(t) > 1 else 0 for t in texts], np.int64)
        each, of = np.fromiter(map(logs_of.__getitem__, split_all(texts)), np.float64, n_words.sum()), np.repeat(np.arange(n), n_words)
        logs, known = np.bincount(of, each, n) + end, np.bincount(of, each > 0, n).astype(np.int64) + (end > 0)
        n_tokens = n_words + 1
        return pa.table({
            "id": pa.array(ids, group.column("ids").type.value_type), "held_out": ~learnt(ids), "n_bytes": np.array([len(t) for t in texts]),
            "n_tokens": n_tokens, "n_known": known, "sum_log10_count": logs, "score": result})

    return dealt.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        score, f"id {kind}, held_out boolean, n_bytes long, n_tokens long, n_known long, sum_log10_count double, score double"), values


def in_order(keys: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed keys, sorted, and their values."""
    spread = mix64(keys)
    order = np.argsort(spread)
    return spread[order], value[order]


class Values:
    """Values by hashed key."""

    def __init__(self, spread: np.ndarray, value: np.ndarray):
        self.table, self.value = SortedHashes(spread), value

    @classmethod
    def shared(cls, held: dict) -> Values:
        """Those of a broadcast, indexed once in each Python worker: the broadcast's value stays with it."""
        if "indexed" not in held:
            held["indexed"] = cls(*held["common"])
        return held["indexed"]

    def places(self, keys: np.ndarray) -> np.ndarray:
        return self.table.find(mix64(keys))


def looked_up(common: Values, own: Values, keys: np.ndarray) -> np.ndarray:
    """The value of each key, from the common ones or a part's own answers."""
    at = common.places(keys)
    rare = np.flatnonzero(at < 0)
    out = common.value[at] if len(common.value) else np.zeros(len(keys), np.int64)
    if len(rare):
        answered = own.places(keys[rare])
        if (answered < 0).any():
            raise ValueError("a part was not answered in full")
        out[rare] = own.value[answered]
    return out


def distinct_words(texts: list[bytes]) -> list[bytes]:
    seen: set[bytes] = set()
    for t in texts:
        seen.update(t[:-1].split())
    return list(seen)


def split_all(texts: list[bytes]) -> Iterator[bytes]:
    return itertools.chain.from_iterable(t[:-1].split() for t in texts)


def word_keys(distinct: list[bytes]) -> np.ndarray:
    """Keys of words, then of the end."""
    return np.array([*map(word_key, distinct), END_KEY], np.uint64)


def count_words(tokens: list[list[bytes]], learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the distinct words and the end, and how often the texts to learn from have them."""
    seen, others = collections.Counter(), set()
    for t, own in zip(tokens, learn):
        seen.update(t) if own else others.update(t)
    others.difference_update(seen)
    return word_keys([*seen, *others]), np.array([*seen.values(), *[0] * len(others), int(learn.sum())], np.int64)


def _common(values: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values, at most ``size``, of those that most tasks asked for."""
    least, held = None, 0
    for asked, n in values.groupBy("asked").count().orderBy(F.desc("asked")).toLocalIterator():
        held += n
        if held > size:
            break
        least = asked
    rows = values.where(F.col("asked") >= least if least is not None else F.lit(False)).select("key", "value").toArrow()
    return in_order(np.asarray(rows.column("key")).astype(np.uint64), np.asarray(rows.column("value")))


def _probabilities(counted: DataFrame, depth: int, group_runs: int = 1 << 16) -> DataFrame:
    """``(key, value, asked)``; value: minus the log10 probability of the last byte of each
    run, given those before, in units of 1 / ``SCALE``.

    The trees below the contexts of three bytes are independent, so an ending of two bytes
    that holds more than ``group_runs`` runs is dealt to several groups by the byte before.
    """
    ending, third = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF)), F.shiftright("key", 24).bitwiseAND(F.lit(0xFF))
    sizes = counted.groupBy(ending.alias("e")).agg(F.least(F.ceil(F.count("*") / group_runs), F.lit(256)).cast("int").alias("groups"))
    sizes = F.broadcast(materialize(sizes, "tree_endings"))  # at most 2^16 endings
    placed = counted.withColumn("e", ending).join(sizes, "e").select("key", "n", "asked", "e", F.pmod(third, F.col("groups")).cast("int").alias("g"))

    def upper(group: pa.Table) -> pa.Table:
        runs, n = np.asarray(group.column("key")).astype(np.uint64), np.asarray(group.column("n"))
        node, z, o, below = sums_of_two(runs, n, depth)
        return pa.table({"node": node.astype(np.int64), "z": z, "o": o, "below": below})

    # Nodes of two bytes: sums over the groups of an ending, a row for each ending.
    names = ["node", "z", "o", "below"]
    summed = placed.groupBy("e", "g").applyInArrow(upper, "node long, z double, o double, below double").groupBy("node").agg(
        *[F.sum(c).alias(c) for c in names[1:]])
    summed = materialize(summed, "tree_nodes")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, o, below = (np.asarray(batch.column(c)) for c in names[1:])
            mixed = np.logaddexp(log_kt(z, o), below) - math.log(2)
            yield pa.RecordBatch.from_pydict({"node": np.asarray(batch.column(0)) & 0xFFFF, "z": z, "o": o, "below": mixed})

    # Nodes of one byte or none: at most 2^16 for any corpus.
    one = summed.select(*names).mapInArrow(weigh, "node long, z double, o double, below double").groupBy("node").agg(
        *[F.sum(c).alias(c) for c in names[1:]]).toArrow()
    shared = counted.sparkSession.sparkContext.broadcast(_top({c: np.asarray(one.column(c)) for c in one.column_names}))
    context = F.shiftright("node", 8).bitwiseAND(F.lit(0xFFFF))
    nodes = summed.withColumn("e", context).join(sizes, "e").withColumn("g", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))

    def finish(group: pa.Table, nodes: pa.Table) -> pa.Table:
        runs, n = np.asarray(group.column("key")).astype(np.uint64), np.asarray(group.column("n"))
        p_one, value = np.full((8, len(runs)), 0.5), np.zeros(len(runs), np.int64)
        sums_of_two(runs, n, depth, p_one)
        order = np.argsort(np.asarray(nodes.column("node")))
        node, z, o, below = (np.asarray(nodes.column(c))[order] for c in names)
        two = level(node.astype(np.uint64), z, o, below) if len(node) else None
        for at in blocks(runs):
            p = p_one[:, at].ravel()
            if two:
                p = mix({2: two}, runs[at], range(2, 1, -1), p)
            if len(shared.value[0][0]):
                p = mix(shared.value, runs[at], range(1, -1, -1), p)
            value[at] = np.rint(log10_of(runs[at], p) * -SCALE).astype(np.int64)
        return pa.table({"key": group.column("key"), "value": value, "asked": group.column("asked")}) if len(runs) else EMPTY

    return placed.groupBy("e", "g").cogroup(nodes.groupBy("e", "g")).applyInArrow(finish, "key long, value long, asked long")


EMPTY = pa.table({c: pa.array([], pa.int64()) for c in ("key", "value", "asked")})


def _top(one: dict) -> dict:
    """Levels of one byte and of none, from sums over the level of two."""
    order = np.argsort(one["node"])
    node, z, o, below = (one[c][order] for c in ("node", "z", "o", "below"))
    first = level(node.astype(np.uint64), z, o, below)
    return {1: first, 0: level(shorter(first[0], 0), first[1], first[2], first[3])}


def base_scores(scored: DataFrame, values: DataFrame) -> DataFrame:
    """Adds ``train_tokens`` and ``base_score``: word counts with one added to each."""
    totals = values.where("key < 0").agg(F.coalesce(F.sum("value"), F.lit(0)), F.count(F.when(F.col("value") > 0, 1))).first()
    n, v = totals[0], totals[1]
    return scored.withColumn("train_tokens", F.lit(n).cast("long")).withColumn(
        "base_score", F.col("sum_log10_count") - F.col("n_tokens") * math.log10(n + v + 1))
