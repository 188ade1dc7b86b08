"""Emotion scores for texts: pluggable model, label generator, word-list scorer."""

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sentilake.functions.sentiment import bind, emotion_struct, normalize_sentiment, share
from sentilake.functions.text import build_prompt, comment_bodies, truncate_chars
from sentilake.functions.parsing import parse_scores
from sentilake.schemas import EMOTIONS, MODEL_CHARS, SENTIMENT

Scorer = Callable[[list[str]], list[dict[str, float]]]
Generator = Callable[[list[str]], list[str]]

# A word list up to this size is compiled into the expression; a larger one is joined.
MAX_INLINE_WORDS = 2000

TOKEN_BREAK = "[^a-z]+"


def _in_batches(model: Callable, texts: pd.Series, size: int) -> list:
    """Model output per text, NULL for NULL, fed at most ``size`` texts at a time."""
    filled = texts.dropna()
    answers: list = []
    for start in range(0, len(filled), size):
        answers.extend(model(filled.iloc[start:start + size].tolist()))
    out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
    out.loc[filled.index] = pd.Series(answers, index=filled.index, dtype=object)
    return out.tolist()


def score_emotions(
    df: DataFrame, load: Callable[[], Scorer], text_col: str = "text",
    out_col: str = "sentiment", batch_size: int = 32, max_chars: int | None = MODEL_CHARS,
) -> DataFrame:
    """Add model scores. ``load`` runs once per task and returns the scorer.

    Only the text column crosses to Python. Scores outside [0, 1] give a NULL
    struct; labels that are not emotions drop out.
    """

    @F.pandas_udf(SENTIMENT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = load()
        for texts in batches:
            rows = _in_batches(scorer, texts, batch_size)
            yield pd.DataFrame(
                {e: pd.Series([None if r is None else float(r.get(e, 0.0)) for r in rows],
                              dtype="float64") for e in EMOTIONS}
            )

    raw = predict(truncate_chars(F.col(text_col), max_chars))
    scored = df.withColumn("_raw", raw)
    known = F.when(F.col(f"_raw.{EMOTIONS[0]}").isNotNull(), F.col("_raw"))
    return scored.withColumn(out_col, normalize_sentiment(known)).drop("_raw")


def attach_predictions(posts: DataFrame, predictions: DataFrame, key: str = "post_id") -> DataFrame:
    """Predictions that come as a table, matched by key."""
    return posts.join(predictions, key, "left")


def generate_text(df: DataFrame, load: Callable[[], Generator], prompt: Column,
                  out_col: str = "raw", batch_size: int = 8) -> DataFrame:
    """Add generated text for each prompt."""

    @F.pandas_udf(T.StringType())
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        generator = load()
        for prompts in batches:
            yield pd.Series(_in_batches(generator, prompts, batch_size), dtype=object)

    return df.withColumn(out_col, answer(prompt))


def annotate_posts(df: DataFrame, load: Callable[[], Generator], batch_size: int = 8, **limits: int | None) -> DataFrame:
    """Prompt, generate and parse; adds ``scores``, NULL where the answer is unusable.

    ``limits``: ``post_limit`` and ``comment_limit`` of the prompt, None to lift them.
    """
    prompt = build_prompt(F.col("post_title"), F.col("post_text"), comment_bodies(F.col("post_comments")), **limits)
    return generate_text(df, load, prompt, "_raw", batch_size) \
        .withColumn("scores", parse_scores(F.col("_raw"))).drop("_raw")


# ---- word-list scorer ---------------------------------------------------------

def lexicon_counts(text: Column, lexicon: Mapping[str, str]) -> Column:
    """Struct of word hits per emotion, without a shuffle.

    The tokens are cut down to listed words once; the six counts run over that
    short list.
    """
    tokens = F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_BREAK)
    hits = F.filter(tokens, lambda t: t.isin(*lexicon))
    by_emotion = {e: [w for w, label in lexicon.items() if label == e] for e in EMOTIONS}

    def count(words: Column, e: str) -> Column:
        return F.size(F.filter(words, lambda t: t.isin(*by_emotion[e]))) if by_emotion[e] else F.lit(0)

    return bind(hits, lambda words: emotion_struct(lambda e: count(words, e)))


def lexicon_table(spark: SparkSession, lexicon: Mapping[str, str]) -> DataFrame:
    """A word list as a local table, whose size Spark knows."""
    return spark.createDataFrame(pa.table({"word": list(lexicon), "emotion": list(lexicon.values())}))


def lexicon_scores(
    df: DataFrame, lexicon: Mapping[str, str] | DataFrame, text_col: str = "text",
    out_col: str = "sentiment", max_chars: int | None = None,
) -> DataFrame:
    """Default scorer: share of listed words per emotion, all zero without a hit.

    A mapping of up to ``MAX_INLINE_WORDS`` words is evaluated in place. A larger
    mapping or a table (``word``, ``emotion``) is joined to the exploded tokens; Spark
    broadcasts it when its size allows and splits frequent words otherwise. Hits are
    counted by text, and copies of a text multiply all its counts alike, so both forms
    give every row the same scores, whatever its other columns.
    """
    text = F.coalesce(truncate_chars(F.col(text_col), max_chars), F.lit(""))
    if isinstance(lexicon, Mapping) and len(lexicon) <= MAX_INLINE_WORDS:
        return df.withColumn(out_col, share(lexicon_counts(text, lexicon)))

    if isinstance(lexicon, Mapping):
        lexicon = lexicon_table(df.sparkSession, lexicon)
    keyed = df.withColumn("_text", F.sha2(text, 256))
    words = keyed.select("_text", F.explode(F.split(F.lower(text), TOKEN_BREAK)).alias("word"))
    hits = words.join(lexicon, "word")
    per_text = hits.groupBy("_text").agg(F.struct(*[F.count_if(F.col("emotion") == e).alias(e) for e in EMOTIONS]).alias("_hits"))
    none = F.struct(*[F.lit(0).cast("bigint").alias(e) for e in EMOTIONS])
    return keyed.join(per_text, "_text", "left").withColumn(out_col, share(F.coalesce("_hits", none))).drop("_text", "_hits")
