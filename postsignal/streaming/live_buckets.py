"""Time buckets that late posts correct: partial sums of every micro-batch, merged without reading old posts.

A part holds, for each bucket that a batch's posts fall into, their number, their sums and, of the composite signal,
the sum of squares around its own mean. Parts add up exactly in any order, so a bucket is right at any time, closed
or not. Parts of earlier batches are merged into one by ``merge_parts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsignal.operators.buckets import bucket_start

_SUMS = ("engagement_score", "composite_signal", "recency_decay", "lexical_sentiment")


def bucket_parts(scored: DataFrame, every: str = "1h") -> DataFrame:
    """``bucket, n``, for each signal its sum and number of values, and ``squares``: one row per bucket of the posts."""
    dated = scored.where(F.col("timestamp").isNotNull())
    signal = F.col("composite_signal")
    sums = [F.sum(name).alias(f"{name}_sum") for name in _SUMS] + [F.count(name).alias(f"{name}_n") for name in _SUMS]
    squares = F.coalesce(F.var_pop(signal) * F.count(signal), F.lit(0.0))
    return dated.groupBy(bucket_start(every).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), *sums, squares.alias("squares"))


def _mean(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n"))


def merge_parts(parts: DataFrame) -> DataFrame:
    """One part per bucket: numbers and sums add up, squares are moved to the common mean."""
    totals = parts.groupBy("bucket").agg(
        F.sum("n").alias("n"), *(F.sum(f"{name}_{what}").alias(f"{name}_{what}") for what in ("sum", "n") for name in _SUMS)
    )
    centre = totals.select(F.col("bucket").alias("of_bucket"), _mean("composite_signal").alias("centre"))
    apart = F.col("composite_signal_n") * F.pow(_mean("composite_signal") - F.col("centre"), 2)
    moved = parts.join(centre, F.col("bucket") == F.col("of_bucket"))
    squares = moved.groupBy("bucket").agg(F.sum(F.col("squares") + F.coalesce(apart, F.lit(0.0))).alias("squares"))
    return totals.join(squares, "bucket")


def buckets_of_parts(parts: DataFrame) -> DataFrame:
    """The buckets as ``aggregate_signals`` gives them, in time order."""
    merged = merge_parts(parts)
    n = F.col("composite_signal_n")
    return merged.select(
        F.col("bucket").alias("timestamp"),
        F.col("n").alias("tweet_count"),
        _mean("engagement_score").alias("engagement_score_mean"),
        _mean("composite_signal").alias("composite_signal_mean"),
        F.coalesce("composite_signal_sum", F.lit(0.0)).alias("composite_signal_sum"),
        F.when(n > 1, F.sqrt(F.col("squares") / (n - 1))).alias("composite_signal_std"),
        _mean("recency_decay").alias("recency_decay_mean"),
        _mean("lexical_sentiment").alias("lexical_sentiment_mean"),
    ).orderBy("timestamp")
