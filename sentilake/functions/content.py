"""Rows told apart by what they hold."""

from pyspark.sql import Column, DataFrame, functions as F, types as T


def content_tie(df: DataFrame) -> Column:
    """A hash of a row's content, to put rows of equal rank in the same order every time."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*plain)
