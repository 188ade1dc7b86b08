"""Language identification by interpolated Kneser-Ney character models.

A text is folded to lower-case letters with one space for anything else. Each language
has a model of runs of up to four characters: the longest order uses counts, the shorter
ones the number of different characters seen before the run; absolute discounts are
estimated from the counts of counts. All runs of all languages lie in sorted hash arrays
with one column of log probabilities per language. A text goes to the language with the
lowest cross-entropy per character.

``accepted`` is the calibrated rejection: documents kept out of the counts give the mean
and spread of a language's cross-entropy, and a text is rejected whose cross-entropy lies
above the mean by more than ``tolerance`` times the excess that 99.5 % stay under there, in units
that allow for its length.

Training takes about ``sample_rows`` whole documents of each language, chosen by a hash
of id and text; that is the documented bound of the models. They are dense in the
languages, of which there may be ``MAX_LANGUAGES``; more are an error.

Rules: NULL texts and texts without a letter are ``und``, with score 0, and are not
accepted; so is everything if there is nothing to learn from. Rows without a language
teach nothing. Ties go to the language that sorts first. Columns of the input named like
those added here give way to them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from sentilake.llm.common import OWN, SortedHashes, mix64, slices

ORDER = 4
UNKNOWN = "und"
SPACE = 32
#: Set in the code of a combining mark, which stays where it follows a letter.
MARK = 1 << 20
#: Languages that models are made for at most: the models are dense in them.
MAX_LANGUAGES = 1024
#: Characters counted at most by the score's posterior, and assumed part of mean cross-entropy as noise.
EVIDENCE, NOISE = 40, 0.1


def folding() -> np.ndarray:
    """For each code below 65,536 the lower-case letter, the combining mark with ``MARK``, or the space."""
    table = np.full(1 << 16, SPACE, np.uint32)
    for code in range(1 << 16):
        category = unicodedata.category(chr(code))[0]
        if category == "L":
            low = chr(code).lower()
            table[code] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else code
        elif category == "M":
            table[code] = code | MARK
    return table


def fold_texts(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of all texts, each after three spaces, and where each starts."""
    pad = " " * (ORDER - 1)
    codes = np.frombuffer(pad.join(["", *texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + len(pad)
    wide = codes >= 1 << 16
    folded = table[np.where(wide, 0, codes)]
    if wide.any():
        letter = np.fromiter((chr(c).isalpha() for c in codes[wide]), bool)
        folded[wide] = np.where(letter, codes[wide] & 0xFFFF, SPACE)
    mark = folded >= MARK
    if mark.any():
        letter = np.maximum.accumulate(np.where(mark, 0, np.arange(len(folded))))
        folded = np.where(mark, np.where(folded[letter] == SPACE, SPACE, folded & 0xFFFF), folded)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    of = np.repeat(np.arange(len(texts)), lengths)
    keep = (folded != SPACE) | np.concatenate([[True], folded[:-1] != SPACE])
    keep[(np.arange(len(codes)) - starts[of]) < len(pad)] = True
    return folded[keep], np.concatenate([[0], np.cumsum(np.bincount(of[keep], minlength=len(texts)))])


def run_keys(chars: np.ndarray, order: int) -> np.ndarray:
    """The run of ``order`` characters that ends at each place, packed 16 bits each."""
    out = np.zeros(len(chars), np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.concatenate([np.full(min(back, len(chars)), SPACE, np.uint64), chars[: max(0, len(chars) - back)].astype(np.uint64)])
        out = (out << np.uint64(16)) | shifted
    return out


def own_places(chars: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that belong to a text (not its padding), and the text of each."""
    lengths = np.diff(starts)
    of = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(chars)) - starts[of] >= ORDER - 1
    return np.flatnonzero(inside), of[inside]


def counts_of_runs(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Runs of ``ORDER`` characters and their counts, by language, of ``rows(lang, text)``."""
    table = folding()

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs):
                chars, starts = fold_texts([batch.column(1)[int(i)].as_py() for i in np.flatnonzero(langs == lang)], table)
                keys, n = np.unique(run_keys(chars, ORDER)[own_places(chars, starts)[0]], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(keys), "run": keys.astype(np.int64), "n": n})

    summed = rows.mapInArrow(tally, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    found = summed.toArrow()
    langs = np.array(found.column("lang").to_pylist(), object)
    runs, n = np.asarray(found.column("run")).astype(np.uint64), np.asarray(found.column("n"))
    return {lang: (runs[langs == lang], n[langs == lang]) for lang in sorted(set(langs))}


class Models:
    """Sorted hash arrays of all languages: ``scores`` of runs, ``gammas`` of their contexts."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = list(counts)
        width = len(self.langs)
        keys = {ORDER: [c[0] for c in counts.values()]}
        tables = {ORDER: list(counts.values())}
        for k in range(ORDER - 1, 0, -1):
            mask = np.uint64((1 << (16 * k)) - 1)
            # Continuation counts: in how many longer runs does this one end?
            tables[k] = [np.unique(runs & mask, return_counts=True) for runs, _ in tables[k + 1]]
        letters = np.unique(np.concatenate([t[0] for t in tables[1]])) if width else np.zeros(0, np.uint64)
        below = np.full((len(letters) + 1, width), -np.log(len(letters) + 1.0))
        self.levels = []
        previous = None
        for k in range(1, ORDER + 1):
            union = np.unique(np.concatenate([t[0] for t in tables[k]])) if width else np.zeros(0, np.uint64)
            contexts = np.unique(union >> np.uint64(16))
            place = np.searchsorted(contexts, union >> np.uint64(16))
            scores, gammas = np.zeros((len(union), width)), np.zeros((len(contexts), width))
            if k == 1:
                lower = np.full((len(union), width), -np.log(len(letters) + 1.0))
            else:
                lower = self._score(previous, union & np.uint64((1 << (16 * (k - 1))) - 1), k - 1)
            for j, (runs, n) in enumerate(tables[k]):
                c = np.zeros(len(union))
                c[np.searchsorted(union, runs)] = n
                once, twice = np.count_nonzero(n == 1), np.count_nonzero(n == 2)
                discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
                total = np.bincount(place, c, len(contexts))
                kinds = np.bincount(place, c > 0, len(contexts))
                gamma = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
                gammas[:, j] = np.log(gamma)
                share = np.maximum(c - discount, 0) / np.maximum(total[place], 1)
                scores[:, j] = np.log(share + gamma[place] * np.exp(lower[:, j]))
            previous = (union, scores, contexts, gammas)
            order = [np.argsort(mix64(union)), np.argsort(mix64(contexts))]
            self.levels.append((mix64(union)[order[0]], scores[order[0]].astype(np.float32),
                                mix64(contexts)[order[1]], gammas[order[1]].astype(np.float32)))
        self.unseen = -np.log(len(letters) + 1.0)
        self.calibration = {}

    def _score(self, level, runs, k):
        """Scores of runs that may be new to the level below ``k + 1`` (they never are: suffixes are counted)."""
        union, scores, _, _ = level
        return scores[np.searchsorted(union, runs)]

    def state(self) -> tuple:
        """Arrays only: workers need not have this package to read them."""
        return self.langs, self.levels, self.unseen, self.calibration

    @classmethod
    def restored(cls, state: tuple) -> Models:
        self = cls.__new__(cls)
        self.langs, self.levels, self.unseen, self.calibration = state
        self.index = [(SortedHashes(u), s, SortedHashes(c), g) for u, s, c, g in self.levels]
        return self

    def score(self, chars: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Log probability of the character at each place, in each language."""
        out = np.zeros((len(places), len(self.langs)), np.float32)
        open_ = np.arange(len(places))
        packed = run_keys(chars, ORDER)[places]
        for k in range(ORDER, 0, -1):
            hashes, scores, contexts, gammas = self.index[k - 1]
            runs = packed[open_] & np.uint64((1 << (16 * k)) - 1) if k < 4 else packed[open_]
            at = hashes.find(mix64(runs))
            hit = at >= 0
            out[open_[hit]] += scores[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return out
            at = contexts.find(mix64(runs[~hit] >> np.uint64(16)))
            out[open_[at >= 0]] += gammas[at[at >= 0]]
        out[open_] += np.float32(self.unseen)
        return out

    def entropies(self, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: characters (0 without a letter), mean and standard deviation of the cost in nats by language."""
        chars, starts = fold_texts(texts, table)
        n, width = len(texts), len(self.langs)
        total, squares = np.zeros((n, width)), np.zeros((n, width))
        length, letters = np.zeros(n, np.int64), np.zeros(n, np.int64)
        step = 1 << 18
        places, of = own_places(chars, starts)
        for k in range(0, len(places), step):
            p, o = places[k : k + step], of[k : k + step]
            lo = max(0, p[0] - ORDER + 1)
            cost = -self.score(chars[lo : p[-1] + 1], p - lo).astype(np.float64)
            heads = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
            total[o[heads]] += np.add.reduceat(cost, heads)
            squares[o[heads]] += np.add.reduceat(cost * cost, heads)
            length += np.bincount(o, minlength=n)
            letters += np.bincount(o[chars[p] != SPACE], minlength=n)
        size = np.maximum(length, 1)[:, None]
        mean = total / size
        return np.where(letters > 0, length, 0), mean, np.sqrt(np.maximum(squares / size - mean**2, 0))


def excess(mean, length, centre, spread):
    return (mean - centre) / (spread / np.sqrt(np.maximum(length, 1)) + NOISE * centre)


def train(docs: DataFrame, *, text="text", lang="lang", id="doc_id", where: Column | None = None,
          sample_rows: int = 1500, seed: int = 5) -> Models:
    """Models of every language among the rows of ``docs`` that meet ``where``."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (where if where is not None else F.lit(True)))
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
                       F.xxhash64(F.lit(seed), F.col(id), F.col(text)).alias("key"))
    # One row per language; texts are chosen where they are read, none is shuffled.
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    sizes = rows.sparkSession.createDataFrame([(r.lang, r.n) for r in sizes], "lang string, n long")
    chosen = rows.join(F.broadcast(sizes), "lang").where(F.col("key") / F.lit(2.0**64) + 0.5 < F.lit(float(sample_rows)) / F.col("n"))
    # A language of few documents needs all of them to learn from, and is not calibrated.
    kept_out = (F.pmod(F.xxhash64("key"), F.lit(5)) == 0) & (F.col("n") >= 20)
    models = Models(counts_of_runs(chosen.where(~kept_out).select("lang", "text")))
    _calibrate(models, chosen.where(kept_out).select("lang", "text"))
    return models


def _calibrate(models: Models, rows: DataFrame) -> None:
    if not models.langs:
        return
    shared = rows.sparkSession.sparkContext.broadcast(models.state())
    table = folding()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Models.restored(shared.value)
        for batch in slices(batches):
            length, mean, spread = own.entropies(batch.column(1).to_pylist(), table)
            at = [own.langs.index(x) if x in own.langs else -1 for x in batch.column(0).to_pylist()]
            keep = np.array([i for i, j in enumerate(at) if j >= 0 and length[i] > 0], int)
            pick = np.array(at)[keep] if len(keep) else keep
            yield pa.RecordBatch.from_pydict({
                "lang": [own.langs[j] for j in pick], "n": length[keep], "mean": mean[keep, pick], "spread": spread[keep, pick]})

    found = rows.mapInArrow(measure, "lang string, n long, mean double, spread double").toPandas()
    for lang, own in found.groupby("lang"):
        centre, spread = np.average(own["mean"], weights=own["n"]), np.average(own["spread"], weights=own["n"])
        models.calibration[lang] = (centre, spread, max(1.0, excess(own["mean"], own["n"], centre, spread).quantile(0.995)))


def identify(docs: DataFrame, models: Models, *, text="text", tolerance: float = 4.0) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` (nats) and ``accepted``."""
    shared = docs.sparkSession.sparkContext.broadcast(models.state())
    table = folding()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Models.restored(shared.value)
        limits = np.array([own.calibration.get(x, (np.inf, 1.0, 1.0)) for x in own.langs])
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(OWN + "text").to_pylist()]
            n = len(texts)
            pred, score, entropy, accepted = [UNKNOWN] * n, np.zeros(n), np.zeros(n), np.zeros(n, bool)
            if own.langs and n:
                length, mean, _ = own.entropies(texts, table)
                best = mean.argmin(axis=1)
                entropy = mean[np.arange(n), best]
                gap = (mean - entropy[:, None]) * np.minimum(length, EVIDENCE)[:, None]
                score = np.where(length > 0, 1 / np.exp(-gap).sum(axis=1), 0.0)
                centre, spread, most = limits[best].T
                accepted = (length > 0) & ((excess(entropy, length, centre, spread) <= tolerance * most) | np.isinf(centre))
                entropy = np.where(length > 0, entropy, 0.0)
                pred = [own.langs[j] if k else UNKNOWN for j, k in zip(best, length)]
            rest = batch.drop_columns([OWN + "text"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(pred, pa.string()), pa.array(score), pa.array(entropy), pa.array(accepted)],
                names=[*rest.schema.names, *ADDED])

    kept = [c for c in docs.columns if c.lower() not in ADDED]
    given = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias(OWN + "text"))
    schema = StructType(given.schema.fields[:-1])
    for name, kind in zip(ADDED, (StringType(), DoubleType(), DoubleType(), BooleanType())):
        schema = schema.add(name, kind)
    return given.mapInArrow(predict, schema)


ADDED = ("lang_pred", "score", "cross_entropy", "accepted")
