"""Schemas, status values and parameter records shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass
from math import inf

from pyspark.sql import types as T

# Run status strings and the subset that triggers the fallback source.
SUCCESS = "SUCCESS"
PARTIAL = "PARTIAL"
THROTTLED = "THROTTLED"
LOGIN_REQUIRED = "LOGIN_REQUIRED"
FAILED = "FAILED"
STATUSES = (SUCCESS, PARTIAL, THROTTLED, LOGIN_REQUIRED, FAILED)
FALLBACK_STATUSES = (THROTTLED, LOGIN_REQUIRED, FAILED)

# Post fields that must be present as JSON keys (their value may be null).
REQUIRED_FIELDS = ("tweet_id", "username", "display_name", "timestamp", "content")
COUNT_FIELDS = (
    "reply_count",
    "retweet_count",
    "like_count",
    "view_count",
    "follower_count",
    "following_count",
)

_STRINGS = T.ArrayType(T.StringType())

# Counts are read as text because producers mix 5, "5" and 5.0; cleaning turns them into longs.
POST_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in REQUIRED_FIELDS]
    + [T.StructField("hashtags", _STRINGS), T.StructField("mentions", _STRINGS)]
    + [T.StructField(name, T.StringType()) for name in COUNT_FIELDS]
    + [T.StructField("url", T.StringType())]
)
POST_FIELDS = tuple(POST_SCHEMA.fieldNames())

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("collector_status", T.StringType()),
        T.StructField("collected_started_at", T.TimestampType()),
        T.StructField("collected_ended_at", T.TimestampType()),
    ]
)
ENVELOPE_FIELDS = tuple(ENVELOPE_SCHEMA.fieldNames())

CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("tweet_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_clean", T.StringType()),
        T.StructField("hashtags_norm", _STRINGS),
        T.StructField("mentions_norm", _STRINGS),
    ]
    + [T.StructField(name, T.LongType()) for name in COUNT_FIELDS]
    + [T.StructField("url", T.StringType())]
    + list(ENVELOPE_SCHEMA.fields)
)
CLEAN_FIELDS = tuple(CLEAN_SCHEMA.fieldNames())

FEATURE_FIELDS = ("engagement_score", "lexical_sentiment", "recency_decay", "composite_signal")

BUCKET_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType()), T.StructField("tweet_count", T.LongType())]
    + [
        T.StructField(name, T.DoubleType())
        for name in (
            "engagement_score_mean",
            "composite_signal_mean",
            "composite_signal_sum",
            "composite_signal_std",
            "recency_decay_mean",
            "lexical_sentiment_mean",
        )
    ]
)

SOURCE_RUN_SCHEMA = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("n_records", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)


class ParameterError(ValueError):
    """An operator parameter is outside its valid range."""


# The ranges of the thresholds.
_RANGES = {
    "max_empty_run": (1, inf),
    "max_duplicate_ratio": (0, 1),
    "min_records_per_minute": (0, inf),
    "rolling_batches": (1, inf),
}


@dataclass(frozen=True)
class SourceThresholds:
    """When a source counts as degraded."""

    # The defaults.
    max_empty_run: int = 3
    max_duplicate_ratio: float = 0.85
    min_records_per_minute: float = 0.25
    rolling_batches: int = 5

    def __post_init__(self) -> None:
        for name, (low, high) in _RANGES.items():
            if not low <= getattr(self, name) <= high:
                raise ParameterError(f"{name} = {getattr(self, name)} is outside {low} to {high}")
