"""Raw posts with their run envelope to the fixed cleaned schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsignal.functions.scalars import parse_timestamp, safe_int
from postsignal.functions.text import normalize_entities, normalize_text
from postsignal.schema import CLEAN_FIELDS, COUNT_FIELDS, ENVELOPE_SCHEMA


def _instant(posts: DataFrame, name: str) -> Column:
    """Text is parsed; a column that already holds a time is only brought to TimestampType."""
    if isinstance(posts.schema[name].dataType, T.StringType):
        return parse_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def _count(posts: DataFrame, name: str) -> Column:
    if isinstance(posts.schema[name].dataType, T.StringType):
        return safe_int(F.col(name))
    return F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint"))


def clean_posts(
    posts: DataFrame, carry: tuple[str, ...] = (), keep_marks: bool = False
) -> DataFrame:
    """One narrow projection to ``CLEAN_FIELDS``; ``carry`` lists further columns to keep in front.

    Envelope columns that the input lacks become null, so the result always has the same schema.
    """
    values: dict[str, Column] = {
        "username": normalize_text(F.col("username"), keep_marks),
        "timestamp": _instant(posts, "timestamp"),
        "content_clean": normalize_text(F.col("content"), keep_marks),
        "hashtags_norm": normalize_entities(F.col("hashtags"), keep_marks),
        "mentions_norm": normalize_entities(F.col("mentions"), keep_marks),
    }
    values.update({name: _count(posts, name) for name in COUNT_FIELDS})
    for field in ENVELOPE_SCHEMA:
        known = F.col(field.name) if field.name in posts.columns else F.lit(None)
        values[field.name] = known.cast(field.dataType)
    return posts.select(
        *carry, *(values.get(name, F.col(name)).alias(name) for name in CLEAN_FIELDS)
    )
