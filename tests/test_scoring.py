import os
import subprocess
import sys
from pathlib import Path

import pytest
from sentilake.operators import scoring as S

WORDS = {"glad": "joy", "joyful": "joy", "sad": "sadness", "boo": "surprise"}
TEXTS = [("a", "Glad, glad! a SAD day"), ("b", "nothing here"), ("c", None), ("d", "gladly éboo boo_boo")]


def moods(df):
    return {r["post_id"]: r["sentiment"] and tuple(r["sentiment"]) for r in df.collect()}


def test_word_list_in_place_and_joined(spark):
    df = spark.createDataFrame(TEXTS, "post_id string, text string")
    third = 1 / 3
    want = {"a": (2 * third, third, 0, 0, 0, 0), "b": (0,) * 6, "c": (0,) * 6, "d": (0, 0, 0, 0, 0, 1)}
    inline = moods(S.lexicon_scores(df, WORDS))
    assert inline == {k: pytest.approx(v) for k, v in want.items()}
    assert moods(S.lexicon_scores(df, S.lexicon_table(spark, WORDS))) == inline
    many = {**WORDS, **{f"{a}{b}{c}q": "fear" for a in "abcdefghijklmn" for b in "abcdefghijklm" for c in "abcdefghijkl"}}
    assert len(many) > S.MAX_INLINE_WORDS
    assert moods(S.lexicon_scores(df, many)) == inline


def test_word_list_needs_no_shuffle(spark):
    df = spark.createDataFrame(TEXTS, "post_id string, text string")
    assert "Exchange" not in S.lexicon_scores(df, WORDS)._jdf.queryExecution().executedPlan().toString()


def load_recorder(path):
    def load():
        with open(path, "a") as f:
            f.write("load\n")

        def score(texts):
            with open(path, "a") as f:
                f.write(f"batch {len(texts)} {max(map(len, texts))}\n")
            return [{"joy": 0.5, "love": 1.5 if t.startswith("bad") else 0.5, "other": 3.0} for t in texts]

        return score

    return load


def test_model_scores_come_in_batches_of_cut_texts(spark, tmp_path):
    log = tmp_path / "log"
    rows = [(f"p{i}", "bad" if i == 3 else None if i == 4 else "x" * 600) for i in range(70)]
    df = spark.createDataFrame(rows, "post_id string, text string").coalesce(1)
    got = moods(S.score_emotions(df, load_recorder(str(log))))
    assert got["p0"] == (0.5, 0, 0, 0, 0.5, 0) and got["p3"] is None and got["p4"] is None
    lines = log.read_text().split("\n")
    assert lines.count("load") == 1
    assert [l for l in lines if l.startswith("batch")] == ["batch 32 512", "batch 32 512", "batch 5 512"]


def test_annotate_pairs_answers_with_posts(spark):
    def load():
        return lambda prompts: ['{"joy": 9}' if "lucky" in p else "?" for p in prompts]

    posts = spark.createDataFrame(
        [("a", "lucky", "b", [("c",)]), ("b", "t", "b", [])],
        "post_id string, post_title string, post_text string, post_comments array<struct<body:string>>")
    got = {r["post_id"]: r["scores"] for r in S.annotate_posts(posts, load).collect()}
    assert tuple(got["a"]) == (9, 1, 1, 1, 1, 1) and got["b"] is None


def test_predictions_from_a_table(spark):
    posts = spark.createDataFrame([("a",), ("b",)], "post_id string")
    predictions = spark.createDataFrame([("a", 1)], "post_id string, score int")
    assert {r["post_id"]: r["score"] for r in S.attach_predictions(posts, predictions).collect()} == {"a": 1, "b": None}


def test_functions_reach_workers_without_the_package(tmp_path):
    """A worker started elsewhere cannot import the package; functions travel by value."""
    code = (
        f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})\n"
        "from pyspark.sql import SparkSession, functions as F\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from sentilake.functions.text import clean_text\n"
        "print('got', spark.range(1).select(clean_text(F.lit('\\ufb03 &amp; x'))).first()[0])\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "got ffi & x" in out.stdout, out.stderr[-2000:]
