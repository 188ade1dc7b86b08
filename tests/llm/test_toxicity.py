"""Toxicity models against Kneser-Ney written out, and on held-out and odd texts."""

import collections
import math

import numpy as np
import pyarrow as pa

from sentilake.llm import toxicity as T
from sentilake.llm.common import fold_column


def plain_log_likelihoods(ordinary, toxic, word):
    """The definition, run by run, from the counts of both classes."""
    K = T.ORDER

    def runs(words):
        out = collections.Counter()
        for w in words:
            marked = "\x01" * (K - 1) + w + "\x02"
            out.update(marked[i : i + K] for i in range(len(marked) - K + 1))
        return out

    by_class = [runs(ordinary), runs(toxic)]
    tables = {K: by_class[0] + by_class[1]}
    for k in range(K - 1, 0, -1):
        tables[k] = collections.Counter(r[1:] for r in tables[k + 1])

    def discount(table):
        once, twice = (sum(n == x for n in table.values()) for x in (1, 2))
        return min(0.95, max(0.1, once / max(1, once + 2 * twice)))

    def interpolated(table, run, lower):
        own = {r: n for r, n in table.items() if r[:-1] == run[:-1]}
        if not own:
            return lower
        d, total = discount(table), sum(own.values())
        return max(own.get(run, 0) - d, 0) / total + d * len(own) / total * lower

    def shared(run):
        if not run:
            return 1 / (len(tables[1]) + 1)
        return interpolated(tables[len(run)], run, shared(run[1:]))

    marked = "\x01" * (K - 1) + word + "\x02"
    out = [0.0, 0.0]
    for i in range(len(marked) - K + 1):
        run = marked[i : i + K]
        for c in (0, 1):
            out[c] += math.log(interpolated(by_class[c], run, shared(run)))
    return out


def test_against_definition():
    ordinary = "the cat sat on the mat with the other cats and a rather long sentence".split()
    toxic = "the vile cat is a vile vilest viler thing".split()
    found = [collections.Counter(), collections.Counter()]
    for f, words in zip(found, (ordinary, toxic)):
        T.count_runs(f, collections.Counter(words))
    runs = sorted(found[0] | found[1])
    models = T.Models(T.codes_of(pa.array(runs)), np.array([[found[0][r], found[1][r]] for r in runs]))
    words = ["the", "vile", "vilely", "cat", "zebra", "x", "sentencewise", "ñandú"]
    got = T.Models.restored(models.state()).score(words)
    for word, own in zip(words, got):
        assert np.allclose(own, plain_log_likelihoods(ordinary, toxic, word), rtol=1e-4)
    assert got[1, 1] - got[1, 0] > 2 and got[2, 1] - got[2, 0] > 1 and abs(got[4, 1] - got[4, 0]) < 1.5


def test_steps_do_not_matter(monkeypatch):
    found = [collections.Counter(), collections.Counter()]
    for f, words in zip(found, (["plain", "words"], ["vile", "words"])):
        T.count_runs(f, collections.Counter(words))
    runs = sorted(found[0] | found[1])
    models = T.Models.restored(T.Models(T.codes_of(pa.array(runs)), np.array([[found[0][r], found[1][r]] for r in runs])).state())
    words = ["plain" * 9, "vile", "w", "words", "o" * 50]
    whole = models.score(words)
    monkeypatch.setattr(T, "STEP", 7)
    assert np.allclose(models.score(words), whole, rtol=1e-5)


def test_held_out(spark):
    """Stems of the toxic class with endings never seen, among made-up words."""
    rng = np.random.default_rng(4)
    parts = ["ta", "ri", "mo", "ke", "su", "lan", "per", "vo"]
    text = lambda: ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(rng.integers(20, 80))]
    rows = []
    for i in range(1200):
        words, toxic = text(), int(i % 4 == 0)
        if toxic:
            for _ in range(max(1, len(words) // 25)):
                words.insert(rng.integers(0, len(words)), rng.choice(["blorg", "zwick"]) + "".join(rng.choice(parts, 2)))
        rows.append((i, " ".join(words), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = T.train(df, df.select("doc_id", "toxic"), where=fold_column("doc_id", 5) != 0)
    held = T.score_texts(df, model).where(fold_column("doc_id", 5) == 0).collect()
    caught = [r.score >= 0.5 for r in held if r.toxic]
    wrong = [r.score >= 0.5 for r in held if not r.toxic]
    assert np.mean(caught) > 0.95 and np.mean(wrong) < 0.02
    again = T.train(df.repartition(7), df.select("doc_id", "toxic").repartition(3), where=fold_column("doc_id", 5) != 0)
    assert np.allclose(model[1], again[1])


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t", "x"), (4, "fine words here", "x"), (4, "fine words here", "x"), (None, "vile words", "x"),
            (5, "word" * 30000, "x"), (6, "a " * 50000, "x"), (7, "vile vile vile", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, SCORE string")
    labels = spark.createDataFrame([(4, 0), (6, 0), (7, 1), (7, 0), (99, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    model = T.train(docs, labels)
    assert abs(model[2] - 1 / 3) < 1e-9
    out = T.score_texts(docs, model)
    assert [c.lower() for c in out.columns].count("score") == 1 and out.count() == len(rows)
    got = {r.doc_id: r for r in out.collect()}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[1].score == got[2].score == got[3].score < 0.5 and got[6].n_words == 50000
    assert got[7].score > got[4].score
    for few in (labels.limit(0), labels.where("toxic = 0")):
        scores = {r.score for r in T.score_texts(docs, T.train(docs, few)).collect()}
        assert scores == {0.0}
    assert T.score_texts(docs.limit(0), model).count() == 0
    assert T.score_texts(docs, T.train(docs.limit(0), labels)).count() == len(rows)
