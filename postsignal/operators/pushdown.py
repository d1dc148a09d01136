"""Filters on cleaned posts that reach the raw scan.

Cleaning parses times, counts and texts, and Spark cannot see through that to filter a scan. A ``CleanFilter`` says what
is wanted of cleaned columns and derives a condition on the raw ones that holds for every post it may keep: plain
comparisons, which Parquet checks against its statistics. The exact condition runs after cleaning.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsignal.operators.clean import clean_posts
from postsignal.schema import COUNT_FIELDS, ParameterError



def _utc(value: datetime) -> datetime:
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


@dataclass(frozen=True)
class CleanFilter:
    """What is wanted of cleaned posts; everything given must hold.

    ``since`` (included) and ``until`` (excluded) bound the time, so undated posts go. ``tweet_ids`` and ``source_names``
    list values. ``least`` gives least values of counts. ``words`` are tokens (lower-case ASCII letters, digits and
    underscores) of which every one must be part of the cleaned text.
    """

    since: datetime | None = None
    until: datetime | None = None
    tweet_ids: tuple[str, ...] = ()
    source_names: tuple[str, ...] = ()
    least: dict[str, int] = field(default_factory=dict)
    words: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if unknown := set(self.least) - set(COUNT_FIELDS):
            raise ParameterError(f"no counts: {sorted(unknown)}")
        for word in self.words:
            if not (word and word.isascii() and word.replace("_", "a").isalnum() and word == word.lower()):
                raise ParameterError(f"not a lower-case word: {word!r}")

    def cleaned(self) -> Column:
        """The exact condition on the columns of ``clean_posts``."""
        conditions = [F.lit(True)]
        if self.since is not None:
            conditions.append(F.col("timestamp") >= F.lit(_utc(self.since)))
        if self.until is not None:
            conditions.append(F.col("timestamp") < F.lit(_utc(self.until)))
        conditions += self._plain()
        conditions += [F.col(name) >= value for name, value in self.least.items()]
        conditions += [F.col("content_clean").contains(word) for word in self.words]
        return reduce(Column.__and__, conditions)

    def _plain(self) -> list[Column]:
        """Conditions on columns that cleaning passes through."""
        wanted = (("tweet_id", self.tweet_ids), ("source_name", self.source_names))
        return [F.col(name).isin(*values) for name, values in wanted if values]

    def raw(self, posts: DataFrame) -> Column:
        """A condition on raw posts that no post fails which ``cleaned`` would keep."""
        conditions = [F.lit(True), *(c for c in self._plain())]
        if self.source_names and "source_name" not in posts.columns:
            conditions = [F.lit(False)]
        if isinstance(posts.schema["timestamp"].dataType, T.StringType):
            conditions += self._text_times()
        else:
            at = F.col("timestamp")
            conditions += [at >= F.lit(_utc(self.since)).cast(posts.schema["timestamp"].dataType)] if self.since is not None else []
            conditions += [at < F.lit(_utc(self.until)).cast(posts.schema["timestamp"].dataType)] if self.until is not None else []
        for name, value in self.least.items():
            # An absent count is 0. Texts sort unlike numbers, so they are only asked to be there.
            is_text = isinstance(posts.schema[name].dataType, T.StringType)
            if value > 0:
                conditions.append(F.col(name).isNotNull() if is_text else F.col(name) >= value)
        for word in self.words:
            # NFKC can make ASCII of other letters, but leaves ASCII texts alone; all else only cuts texts apart.
            conditions.append(F.lower("content").contains(word) | F.col("content").rlike("[^\\x00-\\x7F]"))
        return reduce(Column.__and__, conditions)

    def _text_times(self) -> list[Column]:
        """Bounds on ISO-8601 texts, a day wider on both sides for their offsets from UTC.

        Texts with dashes sort like their dates. Of one year, those without dashes sort behind them, and a date by week
        may carry the year before or after: both are let through by their first letters.
        """
        if self.since is None and self.until is None:
            return []
        low = _utc(self.since) - timedelta(days=1) if self.since is not None else None
        high = _utc(self.until) + timedelta(days=2) if self.until is not None else None
        text, conditions = F.col("timestamp"), [F.col("timestamp").isNotNull()]
        if low is not None:
            weeks = [text.startswith(f"{low.year - 1:04d}{dash}W5") for dash in ("-", "")]
            conditions.append(reduce(Column.__or__, weeks, text >= f"{low:%Y-%m-%d}"))
        if high is not None:
            bare = [text.startswith(f"{high.year:04d}{digit}") for digit in "01W"]
            weeks = [text.startswith(f"{high.year + 1:04d}{dash}W01") for dash in ("-", "")]
            same_year = text.startswith(f"{high.year:04d}-W")
            conditions.append(reduce(Column.__or__, [*bare, *weeks, same_year], text < f"{high:%Y-%m-%d}"))
        return conditions


def clean_posts_where(posts: DataFrame, wanted: CleanFilter, carry: tuple[str, ...] = (), keep_marks: bool = False) -> DataFrame:
    """``clean_posts`` of the posts that ``wanted`` keeps; what can be told of raw posts is filtered at the scan."""
    return clean_posts(posts.where(wanted.raw(posts)), carry, keep_marks).where(wanted.cleaned())
