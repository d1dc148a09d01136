"""Per-post signal expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Market lexicons.
POSITIVE_TERMS = (
    "bull", "bullish", "breakout", "rally", "long", "buy", "support", "upside", "bounce",
    "reversal", "gapup",
)
NEGATIVE_TERMS = (
    "bear", "bearish", "breakdown", "sell", "short", "resistance", "crash", "downside", "gapdown",
    "dump",
)
HALF_LIFE_HOURS = 12.0


def _matches(words: Column, lexicon: tuple[str, ...]) -> Column:
    return F.size(F.array_intersect(words, F.array(*map(F.lit, lexicon))))


def lexical_sentiment(
    words: Column,
    positive: tuple[str, ...] = POSITIVE_TERMS,
    negative: tuple[str, ...] = NEGATIVE_TERMS,
) -> Column:
    """Distinct positive words minus distinct negative words of a token array."""
    return (_matches(words, positive) - _matches(words, negative)).cast("double")


def engagement_score(reply: Column, retweet: Column, like: Column, view: Column) -> Column:
    return reply + retweet * 2 + like + F.log(view + F.lit(1)) * 0.25


def recency_decay(timestamp: Column, now: Column, half_life_hours: float = HALF_LIFE_HOURS) -> Column:
    """Exponential decay by age in whole seconds, within [0, 1]; 0 without a timestamp."""
    age_seconds = F.floor((F.unix_micros(now) - F.unix_micros(timestamp)) / F.lit(1_000_000))
    age_hours = age_seconds / F.lit(3600.0)
    decay = F.exp(-age_hours * math.log(2) / half_life_hours)
    return F.when(timestamp.isNull(), F.lit(0.0)).otherwise(F.least(F.lit(1.0), decay))


def composite_signal(sentiment: Column, engagement: Column, decay: Column) -> Column:
    return sentiment * F.log1p(engagement) * decay
