"""Token counts by a two-tier lookup in the map, without shuffling pre-tokens.

A text is cut into pre-tokens as the tokenizer cuts it; its count is the sum of their
lengths in tokens. Lengths of frequent pre-tokens come from a table of at most
``tier_one`` entries that every worker holds; the others are encoded once by the library
and kept in a worker cache of at most ``cache_size`` entries. The table only saves time:
counts are those of the library.

Cutting is done here only for texts of common Latin characters, for which lower-casing
is all that the normalizer changes; other texts, and those that contain a special string
of the tokenizer, are encoded whole by the library.

Rules: NULL counts as empty; empty texts have no tokens. Repeated rows count each.
"""

from __future__ import annotations

import collections
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructType

from sentilake.llm.common import OWN, slices

VOCABULARY = "word_bpe_49k.json"
#: Characters that the normalizer only lower-cases.
SIMPLE = re.compile("[\t\n\r\x20-\x7e\u00a0-\u012f\u0131-\u0148\u014a-\u017e]*")
TOP_OF_TASK = 1 << 14
#: Texts cut at a time, and characters that the library encodes at a time (one text at least).
SLICE, ENCODED = 128, 1 << 18


def one_thread() -> None:
    """A task has one core; the library would start a thread, with memory of its own, for every core of the machine."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def portions(texts: list[str], characters: int) -> Iterator[list[str]]:
    """The texts in order, cut where ``characters`` are reached."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t) + 1
        if size >= characters:
            yield part
            part, size = [], 0
    if part:
        yield part


class PreTokens:
    """Cuts texts like the tokenizer of ``spec`` and encodes single pre-tokens."""

    def __init__(self, spec: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        parts = json.loads(spec)
        self.special = [t["content"] for t in parts["added_tokens"]]
        self.cut = regex.compile(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall

    def simple(self, text: str) -> bool:
        return SIMPLE.fullmatch(text) is not None and not any(s in text for s in self.special)

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for part in portions(texts, ENCODED) for e in self.tokenizer.encode_batch(part, add_special_tokens=False)]


def frequent(docs: DataFrame, spec: str, text: str, id: str, tier_one: int, one_in: int) -> dict[str, int]:
    """Lengths of the commonest pre-tokens among one document of ``one_in``.

    A task reports its commonest ones only; the driver gets ``tier_one`` rows.
    """
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        pre, seen = PreTokens(spec), collections.Counter()
        for batch in slices(batches, SLICE):
            for t in batch.column(0).to_pylist():
                if t and pre.simple(t):
                    seen.update(pre.cut(t.lower()))
                    if len(seen) > 16 * TOP_OF_TASK:
                        seen = collections.Counter(dict(seen.most_common(TOP_OF_TASK)))
        top = seen.most_common(TOP_OF_TASK)
        yield pa.RecordBatch.from_pydict({"p": [p for p, _ in top], "n": pa.array([n for _, n in top], pa.int64())})

    some = docs.where(F.pmod(F.xxhash64(id, text), F.lit(one_in)) == 0).select(text)
    counted = some.mapInArrow(tally, "p string, n long").groupBy("p").agg(F.sum("n").alias("n"))
    top = [r[0] for r in counted.orderBy(F.desc("n"), "p").limit(tier_one).collect()]
    return dict(zip(top, PreTokens(spec).lengths(top))) if top else {}


def count_tokens(docs: DataFrame, *, text="text", id="doc_id", vocabulary: str | None = None,
                 tier_one: int = 1 << 16, cache_size: int = 1 << 18, one_in: int = 32) -> DataFrame:
    """All columns of ``docs`` with ``n_bytes`` and ``n_tokens`` (replacing such columns)."""
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        spec = f.read()
    context = docs.sparkSession.sparkContext
    shared_spec = context.broadcast(spec)
    shared_table = context.broadcast(frequent(docs, spec, text, id, tier_one, one_in))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        pre, table = PreTokens(shared_spec.value), shared_table.value
        known = dict(table)
        for batch in slices(batches, SLICE):
            texts = [t or "" for t in batch.column(given_text).to_pylist()]
            n_tokens, cut, odd, missing = [0] * len(texts), {}, [], set()
            for i, t in enumerate(texts):
                if pre.simple(t):
                    cut[i] = tokens = pre.cut(t.lower())
                    missing.update(tokens)
                else:
                    odd.append(i)
            missing.difference_update(known)
            misses = list(missing)
            if len(known) + len(misses) > max(cache_size, len(table) + len(misses)):
                known = dict(table)
                misses = [p for ps in cut.values() for p in ps]
                misses = list(set(misses).difference(known))
            known.update(zip(misses, pre.lengths(misses)) if misses else ())
            for i, tokens in cut.items():
                n_tokens[i] = sum(map(known.__getitem__, tokens))
            for i, n in zip(odd, pre.lengths([texts[i] for i in odd]) if odd else ()):
                n_tokens[i] = n
            rest = batch.select(kept)
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n_tokens, pa.int64())],
                names=[*rest.schema.names, "n_bytes", "n_tokens"])

    kept = [c for c in docs.columns if c.lower() not in ("n_bytes", "n_tokens")]
    # A text that is kept crosses to Python once.
    given_text = text if text in kept else OWN + "text"
    own = [] if text in kept else [F.col(text).alias(given_text)]
    given = docs.select(*[F.col(f"`{c}`") for c in kept], *own)
    schema = StructType(given.schema.fields[:len(kept)]).add("n_bytes", LongType()).add("n_tokens", LongType())
    return given.mapInArrow(count, schema)
