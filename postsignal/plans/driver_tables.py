"""Posts, collection batches and captured pages derived from the driver's tables.

The tables hold documents, events and pages but no posts, so these statements map them: every
document becomes a post, with ids, texts, times and counts that exercise the operators (missing and
repeated ids, repeated texts, times in several notations, tags, mentions, links, lexicon words). The
text of each statement runs in Spark and in DuckDB alike; braces name the tables.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsignal.functions.text import extract_hashtags, extract_mentions
from postsignal.operators.rows import spread

# Inside the time range of the events table, so that some posts lie in the future.
AS_OF = datetime(2024, 1, 15, 12, 0, 0, tzinfo=timezone.utc)

POSTS = """
SELECT d.doc_id AS ingest_seq,
       CASE WHEN d.doc_id % 10 = 3 THEN NULL
            WHEN d.doc_id % 10 = 4 THEN ''
            WHEN d.doc_id % 10 = 7 THEN CAST(d.doc_id - 1 AS STRING)
            ELSE CAST(d.doc_id AS STRING) END AS tweet_id,
       concat('User_', CAST(e.user_id AS STRING)) AS username,
       d.source AS display_name,
       CASE d.doc_id % 50
            WHEN 9 THEN NULL
            WHEN 19 THEN 'yesterday'
            WHEN 29 THEN concat(replace(CAST(e.ts AS STRING), ' ', 'T'), '+05:30')
            WHEN 39 THEN concat(replace(CAST(e.ts AS STRING), ' ', 'T'), 'Z')
            WHEN 49 THEN concat(replace(replace(CAST(e.ts AS STRING), '-', ''), ' ', 'T'), '-0800')
            ELSE CAST(e.ts AS STRING) END AS timestamp,
       CASE WHEN d.doc_id % 10 = 4 THEN concat('Repeat ', e.event_type)
            ELSE concat(d.text, ' https://x.com/s/', CAST(d.doc_id AS STRING),
                        ' #', e.event_type, ', #', upper(d.lang),
                        ' @user_', CAST(e.user_id AS STRING),
                        CASE e.event_type WHEN 'purchase' THEN ' bullish breakout'
                                          WHEN 'signup' THEN ' rally'
                                          WHEN 'error' THEN ' bearish breakdown crash'
                                          WHEN 'click' THEN ' support resistance'
                                          ELSE '' END) END AS content,
       d.n_chars % 50 AS reply_count,
       e.user_id % 20 AS retweet_count,
       CASE WHEN d.doc_id % 13 = 5 THEN NULL ELSE d.n_chars % 300 END AS like_count,
       d.n_chars * 10 AS view_count,
       CAST(e.user_id * 7 AS BIGINT) AS follower_count,
       CAST(e.user_id % 101 AS BIGINT) AS following_count,
       concat('https://x.com/user_', CAST(e.user_id AS STRING), '/status/',
              CAST(d.doc_id AS STRING), '?s=20') AS url,
       concat('feed_', CAST(d.doc_id % 3 AS STRING)) AS source_name,
       concat('run_', CAST(d.doc_id % 7 AS STRING)) AS run_id,
       e.ts AS event_ts
FROM {documents} d JOIN {events} e ON e.event_id = d.doc_id
"""

# One row per source run, user group and hour; a batch is one hour of a source run.
INGEST_BATCHES = """
SELECT source_name, run_id, batch_seq, min(ts) AS batch_at,
       CAST(sum(CASE WHEN event_type = 'purchase' AND user_id % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT)
           AS new_records,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS duplicates
FROM (SELECT concat('feed_', CAST(user_id % 3 AS STRING)) AS source_name,
             CASE WHEN user_id % 3 = 0 THEN 'run_0'
                  ELSE concat('run_', CAST(user_id % 5 AS STRING)) END AS run_id,
             CAST(floor(extract(day FROM ts) * 24 + extract(hour FROM ts)) AS BIGINT) AS batch_seq,
             ts, event_type, user_id
      FROM {events}) keyed
GROUP BY source_name, run_id, batch_seq
"""

# One run per source and run id of the posts, with the outcome it reported.
SOURCE_RUNS = """
SELECT source_name, run_id, count(*) AS n_records,
       CASE WHEN run_id = 'run_6' THEN count(*) ELSE count(*) + 5 END AS row_limit,
       CASE WHEN run_id = 'run_1' THEN 'PARTIAL' ELSE 'SUCCESS' END AS raw_status,
       CASE WHEN run_id = 'run_2' THEN 'rate_limited'
            WHEN run_id = 'run_3' THEN 'login_wall'
            WHEN run_id = 'run_4' AND source_name = 'feed_1' THEN 'other' END AS error_kind,
       CASE WHEN run_id IN ('run_2', 'run_3') THEN concat('stopped at ', CAST(max(ingest_seq) AS STRING))
            END AS error_message,
       run_id = 'run_5' AND source_name = 'feed_2' AS degraded_before_start,
       min(event_ts) AS started_at, max(event_ts) AS ended_at
FROM {posts} GROUP BY source_name, run_id
"""

# Six hours of a source run as one batch: richer than INGEST_BATCHES, with login walls seen ahead of some batches.
RUN_BATCHES = """
SELECT concat('feed_', CAST(user_id % 3 AS STRING)) AS source_name,
       concat('run_', CAST(user_id % 7 AS STRING)) AS run_id,
       CAST(floor((extract(day FROM ts) * 24 + extract(hour FROM ts)) / 6) AS BIGINT) AS batch_seq,
       min(ts) AS batch_at,
       CAST(sum(CASE WHEN event_type IN ('view', 'click', 'purchase') AND user_id % 4 <> 1 THEN 1 ELSE 0 END) AS BIGINT)
           AS new_records,
       CAST(sum(CASE WHEN event_type = 'error' OR user_id % 5 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
       max(CASE WHEN event_type = 'signup' AND event_id % 37 = 5 AND user_id % 2 = 0 THEN 1 ELSE 0 END) = 1 AS login_wall
FROM {events} GROUP BY 1, 2, 3
"""

# The runs of some batches, and one without batches for each source.
CAPTURE_RUNS = """
SELECT source_name, run_id, min(batch_at) - INTERVAL '30' MINUTE AS started_at,
       CAST(CASE run_id WHEN 'run_1' THEN 5 WHEN 'run_2' THEN 40 WHEN 'run_3' THEN NULL WHEN 'run_4' THEN 0
            ELSE 1000000 END AS BIGINT) AS row_limit,
       run_id = 'run_5' AND source_name = 'feed_2' AS degraded_before_start,
       CASE WHEN run_id = 'run_6' THEN 'other' END AS error_kind,
       CASE WHEN run_id = 'run_6' THEN 'capture broke off' END AS error_message
FROM {batches} GROUP BY source_name, run_id
UNION ALL
SELECT source_name, 'run_empty', min(batch_at), CAST(10 AS BIGINT), false, NULL, NULL FROM {batches} GROUP BY source_name
"""

# Posts with the batch that brought them, six hours of their run, and those batches.
LIVE_POSTS = """
SELECT *, CAST(floor((extract(day FROM event_ts) * 24 + extract(hour FROM event_ts)) / 6) AS BIGINT) AS batch_seq FROM {posts}
"""
CAPTURES = """
SELECT source_name, run_id, batch_seq, min(event_ts) AS batch_at, max(CASE WHEN ingest_seq % 97 = 13 THEN 1 ELSE 0 END) = 1 AS login_wall
FROM {posts} GROUP BY source_name, run_id, batch_seq
"""

# Captured article fragments: links, texts and counter labels as a browser would show them.
ARTICLES = """
SELECT d.doc_id AS ingest_seq,
       CASE WHEN d.doc_id % 11 = 5 THEN 'https://x.com/home'
            ELSE concat('https://x.com/user_', CAST(e.user_id AS STRING), '/status/',
                        CAST(d.doc_id AS STRING), '?s=20') END AS href,
       CASE WHEN d.doc_id % 17 = 3 THEN '  '
            ELSE concat(' ', d.text, ' #', e.event_type, '; by @user_',
                        CAST(e.user_id AS STRING), ' ') END AS text,
       CASE WHEN d.doc_id % 9 = 2 THEN ' '
            ELSE concat(' ', d.source, ' desk ', chr(10), d.text) END AS body_text,
       CAST(e.ts AS STRING) AS datetime,
       CASE d.doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Reply' ELSE 'no count' END AS reply_label,
       concat(CAST(e.user_id % 20 AS STRING), ' replies') AS reply_text,
       concat(CAST(d.n_chars % 97 AS STRING), '.', CAST(d.n_chars % 10 AS STRING),
              CASE d.doc_id % 4 WHEN 0 THEN 'K' WHEN 1 THEN 'm' WHEN 2 THEN 'B' ELSE '' END)
           AS like_text,
       CASE WHEN d.doc_id % 6 = 1 THEN '' ELSE concat(CAST(d.n_chars AS STRING), ',000 views') END
           AS view_text
FROM {documents} d JOIN {events} e ON e.event_id = d.doc_id
"""

# Page text with a login phrase planted in some pages.
CAPTURED_PAGES = """
SELECT page_id, url, html,
       CASE page_id % 6 WHEN 0 THEN concat(html, ' Log in to X ')
                        WHEN 1 THEN concat('DON''T MISS what''s happening', html)
                        ELSE html END AS page_text,
       CASE WHEN page_id % 3 = 0
            THEN concat('<a href="/acct_', CAST(page_id AS STRING), '/status/',
                        CAST(page_id * 31 AS STRING), '?src=hash">') ELSE '' END AS extra_link
FROM {pages}
"""


# Columns of the tables used here: a read with a schema needs no look into the files first.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# The tables with long texts, and their key.
_TEXT_TABLES = {"documents": "doc_id", "pages": "page_id"}


def _query(spark: SparkSession, sf_dir: str, statement: str, *names: str) -> DataFrame:
    frames = {name: table(spark, sf_dir, name) for name in names}
    for name in names:
        if name in _TEXT_TABLES:
            frames[name] = spread(frames[name], _TEXT_TABLES[name])
    return spark.sql(statement, **frames)


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``posts`` without tags and mentions."""
    return _query(spark, sf_dir, POSTS, "documents", "events")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts: POST fields, ``ingest_seq``, the run keys, and ``event_ts``."""
    return with_entities(raw_posts(spark, sf_dir))


def with_entities(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "hashtags": extract_hashtags(F.col("content")),
            "mentions": extract_mentions(F.col("content")),
        }
    )


def ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = _query(spark, sf_dir, INGEST_BATCHES, "events")
    return batches.withColumn("batch_at", F.col("batch_at").cast("timestamp"))


def source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spark.sql(SOURCE_RUNS, posts=_query(spark, sf_dir, POSTS, "documents", "events"))
    return runs.withColumns(
        {
            "started_at": F.col("started_at").cast("timestamp"),
            "ended_at": F.col("ended_at").cast("timestamp"),
        }
    )


def _with_times(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: F.col(name).cast("timestamp") for name in names})


def capture_runs(spark: SparkSession, batches: DataFrame) -> DataFrame:
    return _with_times(spark.sql(CAPTURE_RUNS, batches=batches), "started_at")


def run_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_times(_query(spark, sf_dir, RUN_BATCHES, "events"), "batch_at")


def live_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LIVE_POSTS, posts=posts(spark, sf_dir))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of ``live_posts``."""
    raw = spark.sql(LIVE_POSTS, posts=_query(spark, sf_dir, POSTS, "documents", "events"))
    return _with_times(spark.sql(CAPTURES, posts=raw), "batch_at")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured articles in the shape ``sources.articles.extract_posts`` reads."""
    captured = _query(spark, sf_dir, ARTICLES, "documents", "events")
    return captured.select(
        "ingest_seq",
        F.array(F.lit("https://x.com/explore"), F.col("href")).alias("hrefs"),
        "text",
        "body_text",
        "datetime",
        F.array("reply_label", "reply_text").alias("reply_raw"),
        F.array(F.lit("Repost"), F.lit(None).cast("string")).alias("retweet_raw"),
        F.array("like_text").alias("like_raw"),
        F.array("view_text").alias("view_raw"),
    )


def captured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _query(spark, sf_dir, CAPTURED_PAGES, "pages")
