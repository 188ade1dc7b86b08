"""Reading emotion scores out of generated text."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

from sentilake.functions.text import strip_text
from sentilake.schemas import EMOTIONS, SCORE_MAX, SCORE_MIN

# Code fences, the object inside the text, integers as text.
FENCE = r"(?imd)^```(?:json)?|```$"
OBJECT = r"(?s)(\{.*\})"
INTEGER_TEXT = r"\A[+-]?[0-9]+(_[0-9]+)*\z"

_OPTIONS = {"allowSingleQuotes": "false"}
_FIELDS = ",".join(f"{e}:variant" for e in EMOTIONS)


def clamp(c: Column, low: int = SCORE_MIN, high: int = SCORE_MAX) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def _whole_number(v: Column) -> Column:
    """A JSON value as a whole number, NULL when it is not one.

    Doubles are exact over the range that survives the clamp, so very long
    integers need no wider type.
    """
    kind = F.schema_of_variant(v)
    text = strip_text(F.try_variant_get(v, "$", "string"))
    from_text = F.when(text.rlike(INTEGER_TEXT), F.replace(text, F.lit("_"), F.lit("")))
    number = F.try_variant_get(v, "$", "double")
    finite = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    return F.when(kind == "STRING", from_text.try_cast("double")).otherwise(finite)


def parse_scores(raw: Column) -> Column:
    """Six scores from 1 to 10, or NULL when any part of the answer is unusable.

    The object is wrapped in brackets before parsing so that text between two
    objects makes the answer invalid. Fields read as variants keep a missing key
    (worth 1) apart from a JSON null (invalid).
    """
    body = strip_text(F.regexp_replace(strip_text(raw), FENCE, ""))
    found = F.nullif(F.regexp_extract(body, OBJECT, 1), F.lit(""))
    parsed = F.from_json(
        F.concat(F.lit("["), found, F.lit("]")), f"array<struct<{_FIELDS}>>", _OPTIONS
    )

    def read(obj: Column) -> Column:
        def score(e: str) -> Column:
            value = F.when(obj[e].isNull(), F.lit(1.0)).otherwise(_whole_number(obj[e]))
            return F.when(value.isNotNull(), F.floor(clamp(value)).cast("int"))

        return F.struct(*[score(e).alias(e) for e in EMOTIONS])

    def complete(scores: Column) -> Column:
        known = reduce(and_, [scores[e].isNotNull() for e in EMOTIONS])
        return F.when(known, scores)

    scored = F.transform(F.transform(parsed, read), complete)
    return F.when(F.size(scored) == 1, F.get(scored, F.lit(0)))
