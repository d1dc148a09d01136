"""Post-level signal columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsignal.functions import signals
from postsignal.functions.scalars import as_of_column
from postsignal.operators.tfidf import Term, with_words, words_tfidf_wide


def add_signals(
    posts: DataFrame,
    as_of: datetime | Column | None = None,
    half_life_hours: float = signals.HALF_LIFE_HOURS,
    lexicons: tuple[tuple[str, ...], tuple[str, ...]] = (signals.POSITIVE_TERMS, signals.NEGATIVE_TERMS),
) -> DataFrame:
    """Engagement, lexical sentiment, recency decay and composite signal; narrow expressions only.

    ``lexicons``: positive and negative words, in lower case.
    """
    return _add_signals(with_words(posts), as_of, half_life_hours, lexicons).drop("_words")


def _add_signals(
    words: DataFrame,
    as_of: datetime | Column | None,
    half_life_hours: float,
    lexicons: tuple[tuple[str, ...], tuple[str, ...]],
) -> DataFrame:
    """``add_signals`` of posts that have their tokens in ``_words``, which stays."""
    scored = words.withColumns(
        {
            "engagement_score": signals.engagement_score(
                F.col("reply_count"), F.col("retweet_count"), F.col("like_count"), F.col("view_count")
            ),
            "lexical_sentiment": F.when(
                F.col("content_clean").isNotNull(), signals.lexical_sentiment(F.col("_words"), *lexicons)
            ),
            "recency_decay": signals.recency_decay(
                F.col("timestamp"), as_of_column(as_of), half_life_hours
            ),
        }
    )
    composite = signals.composite_signal(
        F.col("lexical_sentiment"), F.col("engagement_score"), F.col("recency_decay")
    )
    return scored.withColumn("composite_signal", composite)


def add_features(
    posts: DataFrame,
    terms: list[Term],
    as_of: datetime | Column | None = None,
    half_life_hours: float = signals.HALF_LIFE_HOURS,
    lexicons: tuple[tuple[str, ...], tuple[str, ...]] = (signals.POSITIVE_TERMS, signals.NEGATIVE_TERMS),
) -> DataFrame:
    """Signals plus the wide TF-IDF columns of a fitted vocabulary; both read the tokens that are cut once."""
    return words_tfidf_wide(_add_signals(with_words(posts), as_of, half_life_hours, lexicons), terms)
