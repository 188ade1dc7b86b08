"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs between white space and ASCII punctuation. A first pass over
all documents counts in how many of them each n-gram of a test item occurs. Of every few
neighbouring n-grams of an item the rarest is a seed, so that seeds lie all along the
item, also where the whole item is common; of a short item all are. A second pass finds the seeds in documents,
cuts a passage around each hit and aligns it with the item by words: a match scores 1, a
substitution, insertion or deletion -1. A document is a copy of an item if its best score
reaches ``share`` of the item's words, and ``least_words`` (or the whole of a shorter
item). That allows for about 30 edited words of a hundred.

The test items are worked through in blocks of at most ``block_words`` words, whose
n-grams and words every task holds; each further block is one more pass. Items count
with all their words and documents with their whole texts; nothing is shuffled but one
count for each n-gram and task.

Rules: NULL and empty texts match nothing, and items of fewer words than an n-gram match
nothing. Repeated rows are matched each. Items with the same text are all reported.
"""

from __future__ import annotations

import collections
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sentilake.llm.common import mix64

GRAM, SPREAD = 3, 4
#: Words up to which all n-grams of an item are seeds, as edits leave few of them whole.
SHORT = 48
UPPER = bytes(range(65, 91))
TABLE = bytes(32 if c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 128 else c + 32 * (c in UPPER) for c in range(256))
MOST = 1 << 20


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


class Items:
    """Word numbers of the items of a block, and the n-grams made of them."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.numbers, self.words = ids, {}, []
        for t in texts:
            self.words.append(np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in plain_words(t)], np.int64))
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.counts = [collections.Counter(w.tolist()) for w in self.words]

    def number(self, text: str | None) -> np.ndarray:
        """Word numbers of a text; 0 for words that no item has."""
        tokens = plain_words(text)
        get = self.numbers.get
        return np.fromiter((get(w, 0) for w in tokens), np.int64, len(tokens))


def grams(numbers: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n-gram that starts at each place; 0 where a word is unknown."""
    if len(numbers) < n:
        return np.zeros(0, np.uint64)
    size = len(numbers) - n + 1
    out, known = np.zeros(size, np.uint64), np.ones(size, bool)
    for k in range(n):
        part = numbers[k : k + size]
        out = mix64(out + part.astype(np.uint64))
        known &= part > 0
    return np.where(known, out | np.uint64(1), np.uint64(0))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score, and the place of the passage's words (start, end) that has it."""
    score, end = _scores(item, passage)
    if score <= 0:
        return 0, 0, 0
    back, length = _scores(item[::-1], passage[:end][::-1])
    return score, end - length, end


def _scores(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    n = len(passage)
    ramp = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    best, end = 0, 0
    for w in item:
        diagonal = row[:-1] + np.where((passage == w) & (w > 0), 1, -1)
        new = np.zeros(n + 1, np.int64)
        new[1:] = np.maximum(np.maximum(diagonal, row[1:] - 1), 0)
        # A run of insertions is a running maximum once the slope is taken out.
        row = np.maximum.accumulate(new + ramp) - ramp
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def frequencies(docs: DataFrame, text: str, items: Items, n: int) -> dict[int, int]:
    """In how many documents each n-gram of the items occurs."""
    own = np.unique(np.concatenate([grams(w, n) for w in items.words] or [np.zeros(0, np.uint64)]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(own), np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist() if len(own) else ():
                g = grams(items.number(t), n)
                g = np.unique(g[g > 0])
                at = np.minimum(np.searchsorted(own, g), len(own) - 1)
                seen[at[own[at] == g]] += 1
        hit = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"gram": own[hit].astype(np.int64), "n": seen[hit]})

    counted = docs.select(text).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    return dict(zip(np.asarray(counted.column("gram")).astype(np.uint64).tolist(), counted.column("n").to_pylist()))


def seeds(items: Items, df: dict[int, int], n: int, spread: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted seed hashes with the item and place of each."""
    rows = set()
    for i, w in enumerate(items.words):
        g, near = grams(w, n).tolist(), 1 if len(w) <= SHORT else spread
        for k in range(max(1, len(g) - near + 1)) if g else ():
            at = min(range(k, min(k + near, len(g))), key=lambda p: (df.get(g[p], 0), g[p], p))
            rows.add((g[at], i, at))
    rows = sorted(rows)
    return (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64),
            np.array([r[2] for r in rows], np.int64))


def passages(numbers: np.ndarray, items: Items, index, n: int) -> Iterator[tuple[int, int, int]]:
    """(item, from, to): stretches of a text around seed hits, merged where they touch."""
    keys, owners, places = index
    g = grams(numbers, n)
    at = np.flatnonzero(g)
    if not len(at) or not len(keys):
        return
    lo = np.minimum(np.searchsorted(keys, g[at]), len(keys) - 1)
    hit = keys[lo] == g[at]
    at, lo = at[hit], lo[hit]
    if not len(at):
        return
    count = np.searchsorted(keys, g[at], "right") - lo
    which = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    owner, start = owners[which], np.repeat(at, count) - places[which]
    size = items.sizes[owner]
    pad = size // 3 + 4
    begin, end = np.maximum(start - pad, 0), np.minimum(start + size + pad, len(numbers))
    order = np.lexsort((begin, owner))
    owner, begin, end = owner[order], begin[order], end[order]
    current = None
    for o, b, e in zip(owner.tolist(), begin.tolist(), end.tolist()):
        if current and current[0] == o and b <= current[2]:
            current = (o, current[1], max(current[2], e))
        else:
            if current:
                yield current
            current = (o, b, e)
    yield current


def leaks(docs: DataFrame, benchmark: DataFrame, *, id="doc_id", text="text", item_id="item_id", item_text="text",
          n: int = GRAM, spread: int = SPREAD, share: float = 0.4, least_words: int = 8,
          block_words: int = MOST) -> DataFrame:
    """Every ``(id, item_id)`` where a document holds a test item, with its alignment:
    ``score``, ``item_words``, and ``first_word``, ``last_word`` of the passage. An id may be NULL."""
    return _matched(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "id",
                    benchmark, item_id, item_text, n, spread, share, least_words, block_words)


def clean(docs: DataFrame, benchmark: DataFrame, *, text="text", item_id="item_id", item_text="text", n: int = GRAM,
          spread: int = SPREAD, share: float = 0.4, least_words: int = 8, block_words: int = MOST) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all columns as they are."""
    for block in _blocks(benchmark, item_id, item_text, n, block_words):
        docs = _without(docs, text, block, n, spread, share, least_words)
    return docs


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, n: int, block_words: int) -> Iterator[Items]:
    """Items of a block, so many blocks that each has about ``block_words`` words at most."""
    items = benchmark.where(F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (6 * block_words)))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).toArrow()
        yield Items(rows.column("item").to_pylist(), rows.column("text").to_pylist())


def _found(numbers, items: Items, index, n, share, least_words) -> dict[int, tuple[int, int, int]]:
    best: dict[int, tuple[int, int, int]] = {}
    for item, begin, end in passages(numbers, items, index, n):
        words, passage = items.words[item], numbers[begin:end]
        need = max(share * len(words), min(least_words, len(words)))
        counts = items.counts[item]
        if sum(counts[w] for w in counts.keys() & set(passage.tolist())) < need:
            continue  # no alignment has more matches than this
        score, first, last = align(words, passage)
        if score >= need and score > best.get(item, (0,))[0]:
            best[item] = (score, begin + first, begin + last)
    return best


def _matched(docs, id, benchmark, item_id, item_text, n, spread, share, least_words, block_words) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()
    result = None
    for items in _blocks(benchmark, item_id, item_text, n, block_words):
        index = seeds(items, frequencies(docs, "text", items, n), n, spread)

        def match(batches: Iterator[pa.RecordBatch], items=items, index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, rows = [], []
                for i, t in enumerate(batch.column(1).to_pylist()):
                    for item, (score, first, last) in _found(items.number(t), items, index, n, share, least_words).items():
                        at.append(i)
                        rows.append((items.ids[item], score, len(items.words[item]), first, last))
                columns = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, pa.int64()) for c in columns]],
                    names=["id", "item_id", "score", "item_words", "first_word", "last_word"])

        found = docs.mapInArrow(match, f"id {kind}, item_id long, score long, item_words long, first_word long, last_word long")
        result = found if result is None else result.union(found)
    return result


def _without(docs, text, items, n, spread, share, least_words) -> DataFrame:
    index = seeds(items, frequencies(docs, text, items, n), n, spread)
    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [not _found(items.number(t), items, index, n, share, least_words) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
