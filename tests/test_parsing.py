"""Answers of a generator and the scores read out of them, as literal values."""

import pytest
from pyspark.sql import functions as F

from sentilake.functions.parsing import parse_scores

# Order: joy, sadness, anger, fear, love, surprise.
ANSWERS = [
    ('{"love": 9, "fear": 4}', (1, 1, 1, 4, 9, 1)),
    ('```json\n{"surprise": 6}\n```', (1, 1, 1, 1, 1, 6)),
    ('The post is angry.\n{"anger": 8, "joy": 2}\nHope this helps.', (2, 1, 8, 1, 1, 1)),
    ('{"joy": 40, "sadness": -40}', (10, 1, 1, 1, 1, 1)),
    ('{"joy": 3.7, "fear": "6"}', (3, 1, 1, 6, 1, 1)),
    ('{"mood": "calm"}', (1, 1, 1, 1, 1, 1)),
    ('{"joy": 5', None),
    ('{"joy": "high"}', None),
    ('{"joy": null}', None),
    ('{"joy": [5]}', None),
    ('[1, 2, 3]', None),
    ("no opinion", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("raw, want", ANSWERS)
def test_scores_of_an_answer(spark, raw, want):
    got = spark.range(1).select(parse_scores(F.lit(raw).cast("string")).alias("s")).first()["s"]
    assert (got and tuple(got)) == want
