"""Toxicity by class-conditional Kneser-Ney models.

A text is its lower-cased words; a word is its characters between marks for its begin
and end. Toxic and ordinary texts have an interpolated Kneser-Ney model each, over runs
of eight characters of a word. What a class's discounted counts leave goes to one model that
both share: over the counts of all texts, and below eight characters over the number of
different characters seen before a run. So an expression that is rare in both classes, or
in a language with few toxic texts, has nearly the same probability in both. Most words of
a toxic text are ordinary ones: a word there comes from the toxic model with probability
``PORTION``, otherwise from the ordinary one.

The two log-likelihoods of a text, divided by its number of words, are compared; the
odds of their difference come from texts kept out of the counts. The noise of a mean
falls with the root of the length, so the difference also counts times that root.

Training takes at most ``sample_rows`` whole texts of each class, those with the smallest
hash of their id; that is the documented bound of the model, and what is broadcast grows
with it only. A word is scored once per task while a bounded cache holds it.

Rules: NULL and empty texts get the share of toxic ones among the labelled, at most 0.49.
Labels that are NULL or belong to no document teach nothing; a document labelled twice is
toxic if one label says so; repeated rows are learnt from, and scored, each. Without texts
of both classes the score is that share for all (0 without any). Texts of any length are
scored whole, in steps of bounded memory. Columns of the input named like those added
here give way to them.
"""

from __future__ import annotations

import collections
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from sentilake.llm.common import OWN, SortedHashes, mix64, slices

ORDER = 8
BEGIN, END = "\x01", "\x02"
#: Part of the words of a toxic text that the toxic model accounts for.
PORTION = 0.005
#: Texts of a class below which none is kept out to measure the odds.
FEW = 20
#: Words that a task remembers, places and texts scored at once, and runs held before they are handed on.
CACHE, STEP, SLICE, HELD = 1 << 19, 1 << 17, 256, 1 << 19


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def count_runs(found: collections.Counter, words: collections.Counter) -> None:
    """Adds the runs of ``ORDER`` characters that end at each character of the words."""
    for word, n in words.items():
        marked = BEGIN * (ORDER - 1) + word + END
        for i in range(len(marked) - ORDER + 1):
            found[marked[i : i + ORDER]] += n


def codes_of(runs: pa.Array) -> np.ndarray:
    """Characters of runs (runs x ``ORDER``), out of the array's own bytes."""
    if not len(runs):
        return np.zeros((0, ORDER), np.uint32)
    offsets = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset : runs.offset + len(runs) + 1]
    text = runs.buffers()[2][offsets[0] : offsets[-1]].to_pybytes().decode("utf-8", "surrogatepass")
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER)


def longer(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of runs with one more character in front."""
    return mix64(hashes * np.uint64(0x9E3779B97F4A7C15) + codes.astype(np.uint64) + np.uint64(1))


def hashed(codes: np.ndarray, end: int, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` characters before column ``end``."""
    out = np.zeros(len(codes), np.uint64)
    for back in range(1, k + 1):
        out = longer(out, codes[:, end - back])
    return out


def discounted(n: np.ndarray, at: np.ndarray, contexts: int, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each run's last character, and each context's weight of ``lower``:
    absolute discounting of the counts ``n``, whose contexts are ``at``."""
    once, twice = np.count_nonzero(n == 1), np.count_nonzero(n == 2)
    discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
    total, kinds = np.bincount(at, n, contexts), np.bincount(at, n > 0, contexts)
    weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
    return np.maximum(n - discount, 0) / np.maximum(total, 1)[at] + weight[at] * lower, weight


class Models:
    """For each order, hashed runs with log probabilities, and contexts with log weights of
    what is shorter. The longest order has a column for each class (ordinary, toxic)."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        """``codes``: the distinct runs; ``counts``: runs x 2, how often ordinary and toxic texts have each."""
        tables = {ORDER: (np.arange(len(codes)), counts.sum(axis=1).astype(np.float64))}
        for k in range(ORDER - 1, 0, -1):
            # Continuation counts, of all texts: in how many longer runs does this one end?
            held = tables[k + 1][0]
            _, first, n = np.unique(hashed(codes[held], ORDER, k), return_index=True, return_counts=True)
            tables[k] = held[first], n.astype(np.float64)
        self.unseen = -math.log(len(tables[1][0]) + 1.0)
        self.levels, known, p = [], None, None
        for k in range(1, ORDER + 1):
            held, n = tables[k]
            context, at = np.unique(hashed(codes[held], ORDER - 1, k - 1), return_inverse=True)
            lower = np.full(len(held), math.exp(self.unseen)) if k == 1 else p[np.searchsorted(known, hashed(codes[held], ORDER, k - 1))]
            p, weight = discounted(n, at, len(context), lower)
            if k == ORDER:
                by_class = [discounted(counts[:, c].astype(np.float64), at, len(context), p) for c in (0, 1)]
                p, weight = np.stack([x for x, _ in by_class], axis=1), np.stack([w * weight for _, w in by_class], axis=1)
            own = hashed(codes[held], ORDER, k)
            order = np.argsort(own)
            known, p = own[order], p[order]
            self.levels.append((known, np.log(p).astype(np.float32), context, np.log(weight).astype(np.float32)))

    def state(self) -> tuple:
        """Arrays only: workers need not have this package to read them."""
        return self.levels, self.unseen

    @classmethod
    def restored(cls, state: tuple) -> Models:
        self = cls.__new__(cls)
        self.levels, self.unseen = state
        self.index = [(SortedHashes(runs), p, SortedHashes(contexts), w) for runs, p, contexts, w in self.levels]
        return self

    def score(self, words: list[str]) -> np.ndarray:
        """Log-likelihoods of each word (words x 2)."""
        out = np.zeros((len(words), 2))
        pad = BEGIN * (ORDER - 1)
        text = np.frombuffer("".join(pad + w + END for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words)) + ORDER
        ends = np.cumsum(size)
        for k in range(0, len(text), STEP):
            lo, hi = max(0, k - ORDER + 1), min(len(text), k + STEP)
            place = np.arange(k, hi)
            of = np.searchsorted(ends, place, side="right")
            inside = place - (ends[of] - size[of]) >= ORDER - 1
            own = self._score_places(text[lo:hi], place[inside] - lo)
            for c in (0, 1):
                out[:, c] += np.bincount(of[inside], own[:, c], len(words))
        return out

    def _score_places(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        hashes = [np.zeros(len(codes), np.uint64)]
        for k in range(ORDER):
            shifted = np.concatenate([np.zeros(min(k, len(codes)), np.uint32), codes[: max(0, len(codes) - k)]])
            hashes.append(longer(hashes[-1], shifted))
        out = np.zeros((len(at), 2), np.float32)
        left = np.arange(len(at))
        for k in range(ORDER, 0, -1):
            runs, p, contexts, weight = self.index[k - 1]
            found = runs.find(hashes[k][at[left]])
            out[left[found >= 0]] += p[found[found >= 0]].reshape(-1, p.ndim)
            left = left[found < 0]
            found = contexts.find(hashes[k - 1][at[left] - 1])
            out[left[found >= 0]] += weight[found[found >= 0]].reshape(-1, p.ndim)
        out[left] += np.float32(self.unseen)
        return out


def mixed(by_class: np.ndarray) -> np.ndarray:
    """Log-likelihoods of words in ordinary and in toxic texts, from those of the two models."""
    toxic = np.logaddexp(math.log(1 - PORTION) + by_class[:, 0], math.log(PORTION) + by_class[:, 1])
    return np.stack([by_class[:, 0], toxic], axis=1)


class Scorer:
    """Models with a bounded memory of words, for one task."""

    def __init__(self, state: tuple):
        self.models = Models.restored(state)
        self.forget()

    def forget(self) -> None:
        self.places, self.known = {}, np.zeros((0, 2))

    def learn(self, words: set[str]) -> None:
        """Scores words that are not remembered, together."""
        new = list(words.difference(self.places))
        if len(self.places) + len(new) > CACHE:
            self.forget()
            new = list(words)
        if new:
            self.places.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.known = np.concatenate([self.known, mixed(self.models.score(new))])

    def means(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text, and both log-likelihoods per word (texts x 2)."""
        n, mean = np.zeros(len(texts), np.int64), np.zeros((len(texts), 2))
        words = [tokens(text) for text in texts]
        self.learn(set().union(*words))
        for i, own in enumerate(words):
            if own:
                at = np.fromiter(map(self.places.__getitem__, own), np.int64, len(own))
                n[i], mean[i] = len(own), self.known[at].mean(axis=0)
        return n, mean


def features(n: np.ndarray, mean: np.ndarray) -> np.ndarray:
    gap = mean[:, 1] - mean[:, 0]
    return np.stack([np.ones(len(n)), gap, gap * np.sqrt(n)], axis=1)


def fit_odds(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients of a weighted logistic regression, by Newton's method with halved steps."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-12)
    x, beta = x / scale, np.zeros(x.shape[1])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(weight @ (np.logaddexp(0, z) - y * z)) + ridge / 2 * float(b[1:] @ b[1:])

    keep = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(100):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (p - y)) + keep @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(x.shape[1])
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return beta / scale


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, *, id="doc_id", text="text", label="toxic", where: Column | None = None,
          sample_rows: int = 4000, seed: int = 29) -> tuple:
    """``(state of the models or None, coefficients, share of toxic texts)``.

    ``where`` is a condition on the label rows. One in four of the chosen texts measures
    the odds, the others are counted.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & (where if where is not None else F.lit(True)))
    known = known.select(F.col(id).alias("id"), (F.col(label) > 0).cast("int").alias("toxic")).groupBy("id").agg(F.max("toxic").alias("toxic"))
    ids = docs.select(F.col(id).alias("id")).where("id is not null")
    known = known.join(ids, "id", "left_semi").withColumn("key", F.xxhash64(F.lit(seed), "id"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return None, None, share
    chosen = [known.where(F.col("toxic") == c).orderBy("key", "id").limit(sample_rows) for c in (0, 1)]
    # A class of few texts needs all of them to learn from, and measures nothing.
    kept_out = (F.pmod(F.xxhash64("key"), F.lit(4)) == 0) & F.lit(min(sizes.values()) >= FEW)
    chosen = chosen[0].union(chosen[1]).withColumn("kept_out", kept_out).drop("key")
    # At most 2 * sample_rows ids.
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [collections.Counter(), collections.Counter()]
        for batch in batches:
            for toxic, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                count_runs(found[toxic], collections.Counter(tokens(t.as_py())))
                if len(found[toxic]) > HELD:
                    yield packed(found)
        yield packed(found)

    def packed(found: list[collections.Counter]) -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict({
            "toxic": np.repeat(np.arange(2, dtype=np.int32), list(map(len, found))), "run": [r for f in found for r in f],
            "n": np.array([n for f in found for n in f.values()], np.int64)})
        for f in found:
            f.clear()
        return out

    counted = rows.where("not kept_out").select("toxic", "text").mapInArrow(tally, "toxic int, run string, n long").groupBy("run").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("ordinary"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic")).toArrow()
    if not counted.num_rows:
        return None, None, share
    counted = counted.sort_by("run").combine_chunks()
    counts = np.stack([np.asarray(counted.column("ordinary")), np.asarray(counted.column("toxic"))], axis=1)
    codes = codes_of(pa.concat_arrays(counted.column("run").chunks).cast(pa.string()))
    del counted
    state = Models(codes, counts).state()
    del codes, counts
    shared = spark.sparkContext.broadcast(state)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(shared.value)
        for batch in slices(batches, SLICE):
            n, mean = own.means(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(0), "n": n, "ordinary": mean[:, 0], "gap": mean[:, 1]})

    seen = rows.where("kept_out").select("toxic", "text").mapInArrow(measure, "toxic int, n long, ordinary double, gap double").toPandas()
    seen = seen[seen["n"] > 0].sort_values(["toxic", "n", "ordinary", "gap"])
    y = seen["toxic"].to_numpy(np.float64)
    if not 0 < y.sum() < len(y):
        # No texts to measure the odds on: the share, and the likelihoods of sixteen words, decide.
        return state, np.array([math.log(share / (1 - share)), 16.0, 0.0]), share
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    x = features(seen["n"].to_numpy(), seen[["ordinary", "gap"]].to_numpy())
    return state, fit_odds(x, y, weight), share


ADDED = ("score", "log_toxic", "log_ordinary", "n_words")


def score_texts(docs: DataFrame, model: tuple, *, text="text") -> DataFrame:
    """All columns of ``docs`` with ``score`` (0 to 1), both log-likelihoods per word and ``n_words``."""
    state, beta, share = model
    shared = docs.sparkSession.sparkContext.broadcast(state)
    prior = min(share, 0.49)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(shared.value) if shared.value is not None else None
        for batch in slices(batches, SLICE):
            texts = batch.column(OWN + "text").to_pylist()
            if own is None:
                n, mean = np.array([len(tokens(t)) for t in texts], np.int64), np.zeros((len(texts), 2))
                found = np.full(len(texts), prior)
            else:
                n, mean = own.means(texts)
                found = np.where(n > 0, sigmoid(features(n, mean) @ beta), prior)
            rest = batch.drop_columns([OWN + "text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(found), pa.array(mean[:, 1]), pa.array(mean[:, 0]), pa.array(n)],
                names=[*rest.schema.names, *ADDED])

    kept = [c for c in docs.columns if c.lower() not in ADDED]
    given = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias(OWN + "text"))
    schema = StructType(given.schema.fields[:-1])
    for name in ADDED:
        schema = schema.add(name, LongType() if name == "n_words" else DoubleType())
    return given.mapInArrow(score, schema)
