"""Posts from captured page fragments, and predicates over captured pages and links.

A captured article has ``hrefs array<string>, text, body_text, datetime`` and the raw texts its
counters may be read from, most trusted first: ``reply_raw, retweet_raw, like_raw, view_raw``, each an
``array<string>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsignal.functions.scalars import (
    parse_count,
    post_id_from_url,
    url_without_query,
    username_from_url,
)
from postsignal.functions.text import (
    contains_any,
    extract_hashtags,
    extract_mentions,
    first_line,
    strip,
)
from postsignal.operators.rows import with_required_values

# Phrases that show a login wall, and the path part of a link to a post.
LOGIN_MARKERS = (
    "sign in to x",
    "log in to x",
    "sign in to twitter",
    "log in to twitter",
    "don't miss what's happening",
)
STATUS_PATH = "/status/"


def login_wall(page_text: Column, markers: tuple[str, ...] = LOGIN_MARKERS) -> Column:
    return contains_any(page_text, markers)


def first_status_url(hrefs: Column) -> Column:
    """The first link to a post, without its query; null when there is none."""
    return url_without_query(F.get(F.filter(hrefs, lambda href: href.contains(STATUS_PATH)), 0))


def first_count_of(raw_texts: Column) -> Column:
    """First readable count in an array of candidate texts."""
    counts = F.transform(raw_texts, parse_count)
    return F.get(F.filter(counts, lambda count: count.isNotNull()), 0)


def extract_posts(articles: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Posts of the captured articles; those without a post link or text are left out."""
    located = articles.withColumn("_url", first_status_url(F.col("hrefs")))
    content = strip(F.coalesce("text", F.lit("")))
    unknown = F.lit(None).cast("bigint")
    posts = located.select(
        *carry,
        post_id_from_url(F.col("_url")).alias("tweet_id"),
        username_from_url(F.col("_url")).alias("username"),
        first_line(F.col("body_text")).alias("display_name"),
        F.col("datetime").alias("timestamp"),
        content.alias("content"),
        extract_hashtags(content).alias("hashtags"),
        extract_mentions(content).alias("mentions"),
        first_count_of(F.col("reply_raw")).alias("reply_count"),
        first_count_of(F.col("retweet_raw")).alias("retweet_count"),
        first_count_of(F.col("like_raw")).alias("like_count"),
        first_count_of(F.col("view_raw")).alias("view_count"),
        unknown.alias("follower_count"),
        unknown.alias("following_count"),
        F.col("_url").alias("url"),
    )
    return with_required_values(posts)
