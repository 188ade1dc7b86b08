"""Personal data: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns find e-mail addresses, IP addresses, payment cards and telephone numbers.
The random field labels words (runs without white space) as outside, or as the first or a
further word of a span of one of these kinds, from features of the word's shape, its
neighbours' shapes and the word before. It is trained by gradient steps on a small
labelled table and decoded by Viterbi, all sequences of a batch at once. Spans it finds
are added where no pattern span lies; pattern spans always stay.

Only words with a digit or an ``@`` can be part of a span: for all others "outside" is
the only label. A text's best labelling then falls apart into those of its runs of such
words, with their neighbours as features, which is what is decoded.

Places count code points; the end is exclusive. Rules: NULL counts as empty; texts
without digits and ``@`` have no spans. Long runs of digits or letters cost time in
proportion to their length. Columns of the input named like those added give way to them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructType

from sentilake.llm.common import OWN, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in ("B", "I")])
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@`` so that time stays linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", done)


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    if not MARK.search(text):
        return []
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = NO_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(NO_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# Features

EDGE = ".,;:!?\"'()[]{}<>"
CUES = {
    "phone": "tel telephone phone mobile cell call fax whatsapp ring dial telefon telefono téléphone handy rufnummer appelez llame".split(),
    "card": "card visa mastercard amex credit debit karte kreditkarte carte tarjeta".split(),
    "ip": "ip host address server client addr adresse dirección".split(),
    "email": "mail email e-mail contact write correo courriel".split(),
}
CUE_OF = {w: kind for kind, ws in CUES.items() for w in ws}


#: Places (padded) that are decoded together.
CELLS = 1 << 16


def shape(word: str) -> str:
    """Letters as a or A, digits as 9, in runs of one, two or three and more (digits: up to five)."""
    out, last, run = [], "", 0
    for c in word:
        k = "9" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c if c in "@.-+()/:_#%$€=,\"'" else "?"
        run = run + 1 if k == last else 1
        last = k
        if run <= (5 if k == "9" else 2):
            out.append(k)
    return "".join(out)


def word_features(word: str) -> list[str]:
    core = word.strip(EDGE)
    digits = NO_DIGIT.sub("", core)
    n = len(digits)
    parts = core.split(".")
    out = ["bias", "s=" + shape(core), f"n={min(n, 20)}", "h=" + shape(core[:2]), "t=" + shape(core[-2:])]
    out.append("at" if core.count("@") == 1 else "ats" if "@" in core else "no at")
    if "@" in core and DOMAIN.fullmatch(core.rpartition("@")[2]):
        out.append("domain")
    if any(c.isalpha() for c in core):
        out.append("letters")
    if 13 <= n <= 19 and n == len(NO_DIGIT.sub("", core)) and luhn(digits):
        out.append("luhn")
    if len(parts) == 4 and all(p.isdecimal() and len(p) < 4 and int(p) < 256 for p in parts):
        out.append("octets")
    if re.fullmatch(r"[0-9().+/-]+", core or "x"):
        out.append("numeric")
    if core.startswith("00"):
        out.append("00")
    if any(c in "=\"'$€%" for c in word):
        out.append("code")
    return out


def neighbour_features(side: str, word: str | None) -> list[str]:
    if word is None:
        return [side + "edge"]
    core = word.strip(EDGE).lower()
    out = [side + "s=" + shape(core)] if MARK.search(core) else [side + "plain"]
    if core in CUE_OF:
        out.append(side + "cue=" + CUE_OF[core])
    return out


def sequence_features(words: list[str], before: list[str | None], after: str | None) -> list[list[str]]:
    """Features of each word of a run; ``before``: the two words ahead of it."""
    around = [*before, *words, after]
    digits = NO_DIGIT.sub("", "".join(words))
    whole = ["run luhn" if 13 <= len(digits) <= 19 and luhn(digits) else "run none"]
    out = []
    for i, w in enumerate(words):
        out.append(word_features(w) + whole + neighbour_features("p:", around[i + 1]) + neighbour_features("f:", around[i + 3])
                   + [f for f in neighbour_features("pp:", around[i]) if "cue" in f])
    return out


# The field

class Field:
    """Weights of (feature, label) and (label, next label)."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, steps: np.ndarray, start: np.ndarray):
        self.index, self.weights, self.steps, self.start = index, weights, steps, start

    def scores(self, features: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(features), len(LABELS)))
        for i, names in enumerate(features):
            out[i] = self.weights[[self.index[f] for f in names if f in self.index]].sum(0)
        return out


def allowed() -> tuple[np.ndarray, np.ndarray]:
    """0, or minus infinity where a label may not follow (or begin)."""
    steps = np.zeros((len(LABELS), len(LABELS)))
    for j, label in enumerate(LABELS):
        if label.startswith("I-"):
            steps[:, j] = -np.inf
            steps[[j - 1, j], j] = 0
    return steps, np.array([-np.inf if x.startswith("I-") else 0.0 for x in LABELS])


def pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), size.max(), len(LABELS)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out, size


def viterbi(rows: list[np.ndarray], steps: np.ndarray, start: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The best labels of each sequence, and how far their score lies above all-outside."""
    x, size = pad(rows)
    n, length, _ = x.shape
    best, back = start + x[:, 0], np.zeros((n, length, len(LABELS)), np.int8)
    for t in range(1, length):
        ways = best[:, :, None] + steps[None]
        pick = ways.argmax(1)
        new = np.take_along_axis(ways, pick[:, None, :], 1)[:, 0] + x[:, t]
        go = (t < size)[:, None]
        back[:, t] = np.where(go, pick, np.arange(len(LABELS))[None])
        best = np.where(go, new, best)
    label = best.argmax(1)
    path = np.zeros((n, length), np.int8)
    for t in range(length - 1, -1, -1):
        path[:, t] = label
        label = back[np.arange(n), t, label]
    outside = start[0] + x[:, :, 0].sum(1) + steps[0, 0] * (size - 1)
    return [p[:k] for p, k in zip(path, size)], best.max(1) - outside


def train(table: list[tuple[list[list[str]], list[int]]], *, rounds: int = 150, rate: float = 0.3, penalty: float = 3e-4) -> Field:
    """Maximum likelihood with an L2 penalty, by Adam over the whole table at once."""
    index = {f: i for i, f in enumerate(sorted({f for seq, _ in table for fs in seq for f in fs}))}
    k, n_labels = len(index), len(LABELS)
    size = np.array([len(y) for _, y in table])
    n, length = len(table), size.max()
    where = np.repeat(np.arange(n), size), np.concatenate([np.arange(s) for s in size])
    flat = [[index[f] for f in fs] for seq, _ in table for fs in seq]
    tokens = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
    columns = np.concatenate([np.array(f, int) for f in flat])
    gold = np.concatenate([np.array(y, int) for _, y in table])
    follow = np.flatnonzero(where[1] > 0)
    gold_steps = np.zeros((n_labels, n_labels))
    np.add.at(gold_steps, (gold[follow - 1], gold[follow]), 1)
    limit, start = allowed()
    theta = [np.zeros((k, n_labels)), np.zeros((n_labels, n_labels))]
    moments = [[np.zeros_like(t), np.zeros_like(t)] for t in theta]
    for step in range(1, rounds + 1):
        emit = np.zeros((len(flat), n_labels))
        np.add.at(emit, tokens, theta[0][columns])
        x = np.zeros((n, length, n_labels))
        x[where] = emit
        trans = theta[1] + limit
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = np.zeros((n, length, n_labels))
            alpha[:, 0] = start + x[:, 0]
            for t in range(1, length):
                alpha[:, t] = np.logaddexp.reduce(alpha[:, t - 1][:, :, None] + trans, 1) + x[:, t]
            beta = np.zeros((n, length, n_labels))
            for t in range(length - 2, -1, -1):
                on = np.logaddexp.reduce(trans[None] + (x[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where((t + 1 < size)[:, None], on, 0.0)
            z = np.logaddexp.reduce(alpha[np.arange(n), size - 1], 1)
            p = np.exp(alpha + beta - z[:, None, None])[where]
            expected_steps = np.zeros((n_labels, n_labels))
            for t in range(1, length):
                go = np.flatnonzero(t < size)
                pair = alpha[go, t - 1][:, :, None] + trans + (x[go, t] + beta[go, t])[:, None, :] - z[go, None, None]
                expected_steps += np.exp(pair).sum(0)
        p[np.arange(len(gold)), gold] -= 1
        slope = np.zeros((k, n_labels))
        np.add.at(slope, columns, p[tokens])
        slopes = [slope / n + penalty * theta[0], np.where(np.isfinite(limit), (expected_steps - gold_steps) / n, 0) + penalty * theta[1]]
        for t, g, m in zip(theta, slopes, moments):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            t -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    return Field(index, theta[0], theta[1] + limit, start)


def labelled_table(rows: int = 600, seed: int = 13) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The small labelled table: short texts with their spans, each form of the kinds and
    of numbers that are nobody's (dates, prices, versions, keys, references)."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    name = lambda: "".join(pick("abcdefghijklmnoprstuvw") for _ in range(int(rng.integers(2, 9))))
    key = lambda k: "".join(pick("0123456789abcdef") for _ in range(k))
    plain = "the of and in der la que es was on for mit par con zu".split()

    def card(sep: str) -> str:
        body = pick("3456") + num(14)
        digits = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        return sep.join(digits[i : i + 4] for i in range(0, 16, 4))

    makers = {
        "email": [lambda: f"{name()}@{name()}.{pick(['com', 'org', 'de'])}", lambda: f"{name()}.{num(2)}@mail{num(1)}.{name()}.com",
                  lambda: f"{name()}'{name()}@{name()}.com", lambda: f"{name()}&{name()}@{name()}.net", lambda: f"müller{num(2)}@{name()}.de"],
        "ip": [lambda: ".".join(str(x) for x in rng.integers(1, 256, 4))],
        "card": [lambda: card(""), lambda: card(" "), lambda: card("-"), lambda: card(".")],
        "phone": [lambda: f"+{num(2)} {num(3)} {num(6)}", lambda: f"+1 ({num(3)}) {num(3)}-{num(4)}", lambda: f"({num(3)}) {num(3)}-{num(4)}",
                  lambda: f"{num(3)}-{num(3)}-{num(4)}", lambda: f"{num(3)}.{num(3)}.{num(4)}", lambda: f"00{num(2)} {num(3)} {num(7)}",
                  lambda: f"0{num(4)} {num(6)}", lambda: f"+{num(2)}/{num(3)}/{num(6)}"],
    }
    none = [lambda: num(1), lambda: num(2), lambda: f"{num(4)}", lambda: f"20{num(2)}-{num(2)}-{num(2)}", lambda: f"{num(2)}.{num(2)}.20{num(2)}",
            lambda: f"${num(2)}.{num(2)}", lambda: f"{num(1)}.{num(1)}", lambda: f"v{num(1)}.{num(1)}.{num(2)}", lambda: f"{num(2)}:{num(2)}",
            lambda: f'"{key(40)}"', lambda: f"password={key(18)}", lambda: f"AKIA{key(16).upper()}", lambda: f"{num(3)},{num(3)}", lambda: f"{num(2)}%",
            lambda: f"{num(20)}", lambda: f"#{num(5)}", lambda: f"@{name()}", lambda: f"{name()}{num(3)}", lambda: num(16), lambda: f"{num(3)}-{num(2)}",
            lambda: f"ISBN 978-{num(1)}-{num(4)}-{num(4)}-{num(1)}", lambda: f"x={num(3)}", lambda: f"{num(6)}", lambda: f"{num(8)}", lambda: f"{num(10)}",
            lambda: key(32), lambda: f"{num(1)}.{num(1)}.{num(1)}", lambda: f"http://{name()}.com/{num(4)}", lambda: f"{num(4)} {num(4)}",
            lambda: f"{num(2)} {num(3)} {num(2)}", lambda: f"{num(3)} {num(3)} {num(4)}"]
    out = []
    for _ in range(rows):
        text, spans = "", []
        for _ in range(int(rng.integers(1, 4))):
            text += " ".join(pick(plain) for _ in range(int(rng.integers(0, 4)))) + " "
            if rng.random() < 0.5:
                kind = pick(KINDS)
                form = int(rng.integers(len(makers[kind])))
                if kind == "phone" and form in (4, 5, 6) or rng.random() < 0.3:
                    text += pick(CUES[kind]) + pick([" ", ": "])
                item = makers[kind][form]()
                spans.append((kind, len(text), len(text) + len(item)))
            else:
                item = pick(none)()
            text += item + pick(["", "", ".", ","]) + " " + pick(plain) + " "
        out.append((text, spans))
    return out


def runs(text: str) -> list[tuple[list[tuple[int, int]], list[str | None], str | None]]:
    """Runs of words with a digit or ``@``: their places, the two words before, the word after."""
    if not MARK.search(text):
        return []
    out, current, before = [], [], [None, None]
    ahead = list(before)
    for m in re.finditer(r"\S+", text):
        w = m.group()
        if MARK.search(w):
            if not current:
                ahead = list(before)
            current.append(m.span())
        elif current:
            out.append((current, ahead, w))
            current = []
        before = [before[1], w]
    if current:
        out.append((current, ahead, None))
    return out


def training_rows(labelled: list[tuple[str, list[tuple[str, int, int]]]]):
    for text, spans in labelled:
        for places, before, after in runs(text):
            labels = []
            for a, b in places:
                kind = next(((k, s) for k, s, e in spans if a < e and s < b), None)
                labels.append(0 if kind is None else LABELS.index(("B-" if kind[1] >= a else "I-") + kind[0]))
            yield sequence_features([text[a:b] for a, b in places], before, after), labels


def field_spans(texts: list[str], field: Field, margin: float) -> list[list[tuple[str, int, int]]]:
    """Spans of the best labelling, where it beats all-outside by ``margin`` (log odds)."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    work = []
    for i, t in enumerate(texts):
        for places, before, after in runs(t):
            work.append((i, places, field.scores(sequence_features([t[a:b] for a, b in places], before, after))))
    work.sort(key=lambda w: len(w[1]))
    for part in alike_long(work):
        paths, lead = viterbi([w[2] for w in part], field.steps, field.start)
        for (i, places, _), path, gain in zip(part, paths, lead):
            if gain >= margin:
                found[i] += _joined(texts[i], places, path)
    return [sorted(f, key=lambda s: (KINDS.index(s[0]), s[1])) for f in found]


def alike_long(work: list) -> Iterator[list]:
    """Runs in order of length, together so many that their padded scores fit ``CELLS``."""
    k = 0
    while k < len(work):
        end = k + 1
        while end < len(work) and end - k < 512 and (end + 1 - k) * len(work[end][1]) <= CELLS:
            end += 1
        yield work[k:end]
        k = end


def _joined(text: str, places, path) -> Iterator[tuple[str, int, int]]:
    current = None
    for (a, b), label in [*zip(places, path), ((0, 0), 0)]:
        if label and LABELS[label].startswith("I-"):
            current = (current[0], current[1], b)
            continue
        if current:
            kind, start, end = current
            while start < end and text[start] in EDGE.replace("(", ""):
                start += 1
            while end > start and text[end - 1] in EDGE:
                end -= 1
            if end > start:
                yield kind, start, end
        current = (LABELS[label][2:], a, b) if label else None


def personal_data(docs: DataFrame, *, text="text", labelled=None, margin: float = 1.5) -> DataFrame:
    """All columns of ``docs`` with ``spans``, an array of (kind, start, end, by_pattern), by kind, then start."""
    field = train(list(training_rows(labelled if labelled is not None else labelled_table())))
    parts = docs.sparkSession.sparkContext.broadcast((field.index, field.weights, field.steps, field.start))
    span = StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType()).add("by_pattern", BooleanType())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*parts.value)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("by_pattern", pa.bool_())]))
        for batch in slices(batches, 256):
            texts = [t or "" for t in batch.column(OWN + "text").to_pylist()]
            rows = []
            for t, added in zip(texts, field_spans(texts, own, margin)):
                fixed = pattern_spans(t)
                added = [s for s in added if not any(s[1] < e and b < s[2] for _, b, e in fixed)]
                both = [(*s, True) for s in fixed] + [(*s, False) for s in added]
                both.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
                rows.append([dict(zip(("kind", "start", "end", "by_pattern"), s)) for s in both])
            rest = batch.drop_columns([OWN + "text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(rows, kind)], names=[*rest.schema.names, "spans"])

    kept = [c for c in docs.columns if c.lower() != "spans"]
    given = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias(OWN + "text"))
    return given.mapInArrow(find, StructType(given.schema.fields[:-1]).add("spans", ArrayType(span)))
