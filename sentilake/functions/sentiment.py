"""Arithmetic on the six-emotion struct."""

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from sentilake.schemas import EMOTIONS, TEMPERATURE

# A sum this close to one is left as it is.
SUM_REL_TOL = 1e-6
SUM_ABS_TOL = 1e-9


def bind(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to ``c`` evaluated once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def emotion_struct(value_of) -> Column:
    """Struct of six doubles from a function of the label."""
    return F.struct(*[value_of(e).cast("double").alias(e) for e in EMOTIONS])


def emotion_sum(s: Column) -> Column:
    return reduce(add, [s[e] for e in EMOTIONS])


def in_unit_range(s: Column) -> Column:
    """Every emotion lies in [0, 1]; missing ones count as 0."""
    inside = [F.coalesce(s[e], F.lit(0.0)).between(0.0, 1.0) for e in EMOTIONS]
    return reduce(lambda a, b: a & b, inside)


def normalize_sentiment(s: Column) -> Column:
    """Rescale to sum one. NULL for a NULL struct or a value outside [0, 1]."""

    def rescale(v: Column) -> Column:
        total = emotion_sum(v)
        slack = F.greatest(SUM_REL_TOL * F.greatest(F.abs(total), F.lit(1.0)), F.lit(SUM_ABS_TOL))
        keep = (total == 0) | (F.abs(total - 1.0) <= slack)
        divisor = F.when(keep, F.lit(1.0)).otherwise(total)
        return F.when(v.isNotNull() & in_unit_range(v), emotion_struct(lambda e: v[e] / divisor))

    def fill(v: Column) -> Column:
        return F.when(v.isNotNull(), emotion_struct(lambda e: F.coalesce(v[e], F.lit(0.0))))

    return bind(bind(s, fill), rescale)


def share(counts: Column) -> Column:
    """Counts per emotion over their sum; all zero without any."""

    def divide(v: Column) -> Column:
        total = emotion_sum(v)
        divisor = F.when(total == 0, F.lit(1.0)).otherwise(total)
        return emotion_struct(lambda e: v[e] / divisor)

    return bind(counts, divide)


def labels_to_struct(predictions: Column) -> Column:
    """``[{label, score}]`` to one struct; unknown labels drop, missing ones are 0."""

    def last_score(e: str) -> Column:
        hits = F.filter(predictions, lambda p: p["label"] == e)
        return F.coalesce(F.try_element_at(hits, F.lit(-1))["score"], F.lit(0.0))

    return F.when(predictions.isNotNull(), emotion_struct(last_score))


def popularity(score: Column, temperature: float = TEMPERATURE) -> Column:
    """Unnormalised weight of a post.

    ``exp(log1p(score) / T)`` is ``(1 + score) ** (1 / T)``; dividing by the sum over
    all kept posts gives the softmax weight. It cannot overflow a double for any
    64-bit score, so no shift by the maximum is needed.
    """
    return F.pow(1.0 + score, F.lit(1.0 / temperature))
