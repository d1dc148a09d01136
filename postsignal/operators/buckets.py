"""Time buckets over post-level signals."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bucket units. Fixed-length units in microseconds, calendar units in months.
UNIT_MICROS = {
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "m": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
    "w": 604_800_000_000,
}
UNIT_MONTHS = {"mo": 1, "q": 3, "y": 12}

_PART = re.compile(r"(\d+)(us|ms|mo|s|m|h|d|w|q|y)")


@dataclass(frozen=True)
class Every:
    """A bucket width: either microseconds (``offset`` shifts the grid) or calendar months."""

    micros: int = 0
    offset_micros: int = 0
    months: int = 0

    @property
    def duration(self) -> str:
        return f"{self.micros} microseconds"

    @property
    def offset(self) -> str:
        return f"{self.offset_micros} microseconds"


def parse_every(text: str) -> Every:
    """Read a width such as ``15m``, ``1h30m``, ``1w`` or ``1mo``."""
    parts = _PART.findall(text)
    if not parts or "".join(number + unit for number, unit in parts) != text:
        raise ValueError(f"unsupported bucket width: {text!r}")
    micros = sum(int(number) * UNIT_MICROS[unit] for number, unit in parts if unit in UNIT_MICROS)
    months = sum(int(number) * UNIT_MONTHS[unit] for number, unit in parts if unit in UNIT_MONTHS)
    if (micros > 0) == (months > 0):
        raise ValueError(f"bucket width must be positive and not mix months with days: {text!r}")
    # The epoch is a Thursday; week buckets start on Monday.
    weekly = all(unit == "w" for _, unit in parts)
    return Every(micros, 4 * UNIT_MICROS["d"] if weekly else 0, months)


def _calendar_start(timestamp: Column, months: int) -> Column:
    index = F.year(timestamp) * 12 + F.month(timestamp) - 1
    start = index - F.pmod(index, F.lit(months))
    return F.make_date(
        F.floor(start / F.lit(12)).cast("int"), (F.pmod(start, F.lit(12)) + 1).cast("int"), F.lit(1)
    ).cast("timestamp")


def bucket_start(every: str) -> Column:
    """The start of the bucket that ``timestamp`` falls into."""
    width = parse_every(every)
    if width.months:
        return _calendar_start(F.col("timestamp"), width.months)
    place = F.unix_micros("timestamp") - width.offset_micros
    return F.timestamp_micros(place - F.pmod(place, F.lit(width.micros)) + width.offset_micros)


def bucket_statistics() -> list[Column]:
    """The bucket columns; every one of them has a partial form, so a hot bucket stays cheap."""
    signal = F.col("composite_signal")
    return [
        F.count(F.lit(1)).alias("tweet_count"),
        F.avg("engagement_score").alias("engagement_score_mean"),
        F.avg(signal).alias("composite_signal_mean"),
        F.coalesce(F.sum(signal), F.lit(0.0)).alias("composite_signal_sum"),
        F.stddev_samp(signal).alias("composite_signal_std"),
        F.avg("recency_decay").alias("recency_decay_mean"),
        F.avg("lexical_sentiment").alias("lexical_sentiment_mean"),
    ]


def bucketed(posts: DataFrame, every: str = "1h") -> DataFrame:
    """Bucket aggregate without the final sort; also the streaming form for fixed-length widths."""
    width = parse_every(every)
    if width.months:
        if posts.isStreaming:
            raise ValueError("calendar buckets need a batch frame; stream fixed-length ones")
        start = _calendar_start(F.col("timestamp"), width.months)
        dated = posts.where(F.col("timestamp").isNotNull())
        return dated.groupBy(start.alias("timestamp")).agg(*bucket_statistics())
    window = F.window("timestamp", width.duration, width.duration, width.offset)
    grouped = posts.groupBy(window.alias("_window")).agg(*bucket_statistics())
    return grouped.select(F.col("_window.start").alias("timestamp"), *grouped.columns[1:])


def aggregate_signals(posts: DataFrame, every: str = "1h") -> DataFrame:
    """One row per non-empty bucket, labelled by its start, in time order.

    Posts without timestamp belong to no bucket; ``count_undated`` reports how many there are.
    """
    return bucketed(posts, every).orderBy("timestamp")


def count_undated(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count_if(F.col("timestamp").isNull()).alias("undated_posts"))


def signal_series(buckets: DataFrame) -> DataFrame:
    """The two columns a time-series chart of the signal needs, in time order."""
    return buckets.select("timestamp", "composite_signal_mean").orderBy("timestamp")
