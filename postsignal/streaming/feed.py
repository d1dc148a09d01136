"""The operators on a growing feed of posts, with Structured Streaming."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postsignal.functions.text import WHITESPACE
from postsignal.operators.buckets import bucketed
from postsignal.operators.clean import clean_posts
from postsignal.operators.dedupe import keys_hit, unseen_posts, with_cleaned_key, with_record_key
from postsignal.operators.features import add_features, add_signals
from postsignal.operators.tfidf import Term
from postsignal.sinks.tables import write_table
from postsignal.sources.jsonl import parse_lines, post_columns, reject_columns
from postsignal.streaming.history import KeyHistory
from postsignal.streaming.live_buckets import bucket_parts, buckets_of_parts

DEFAULT_DELAY = "1 day"


def read_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of JSON line files as a stream of text lines."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path).withColumnRenamed("value", "line")
    return lines.where(F.col("line").rlike(f"[^{WHITESPACE}]"))


def clean_stream(lines: DataFrame) -> DataFrame:
    """Good lines as cleaned posts. ``line`` may come from files, Kafka values or anything else."""
    return clean_posts(post_columns(parse_lines(lines)))


def with_arrival_time(posts: DataFrame) -> DataFrame:
    """``arrived_at``, the start of the micro-batch that brings the post.

    As event time it makes no post late, and undated posts or dates in the future cannot move its watermark.
    """
    return posts.withColumn("arrived_at", F.current_timestamp())


def dedupe_stream(
    posts: DataFrame, delay: str = DEFAULT_DELAY, event_time: str = "timestamp", salts: int = 8
) -> DataFrame:
    """Drop repeats of a cleaned post that arrive within ``delay`` of event time.

    State is bounded: a key is forgotten ``delay`` after its post, so later repeats pass. With
    ``salts`` a first stage drops repeats per key and group of input tasks, and at most ``salts``
    rows of one key reach the task that holds the key.

    With ``timestamp`` as event time, posts later than the watermark are dropped and undated ones always
    pass; use ``with_arrival_time`` and ``arrived_at`` where every post must come out once.
    """
    keyed = with_cleaned_key(posts).withWatermark(event_time, delay)
    if salts:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        keyed = keyed.withColumn("_salt", salt).dropDuplicatesWithinWatermark(["dedupe_key", "_salt"])
        keyed = keyed.drop("_salt")
    return keyed.dropDuplicatesWithinWatermark(["dedupe_key"]).drop("dedupe_key")


def bucket_stream(scored: DataFrame, every: str = "1h") -> DataFrame:
    """Time buckets of a scored stream; its ``timestamp`` must carry the watermark.

    In append mode a bucket comes out once the watermark has passed its end; posts later than that
    are dropped.
    """
    return bucketed(scored, every)


def score_stream(posts: DataFrame, terms: list[Term]) -> DataFrame:
    """Features with a vocabulary fitted in batch; ages count from each micro-batch's start."""
    return add_features(posts, terms)


def write_stream(frame: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once per checkpoint folder."""
    writer = (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _foreach_batch(
    frame: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool,
) -> StreamingQuery:
    writer = frame.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _feed_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of a checkpoint folder; a new checkpoint has another one."""
    document = spark.read.text(f"{checkpoint}/metadata").first()["value"]
    return json.loads(document)["id"]


def write_good_and_rejected(
    lines: DataFrame,
    posts_path: str,
    rejects_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Cleaned posts to one table and unusable lines, with the reason, to another.

    Each micro-batch owns a partition by ``feed_id`` and ``batch_id`` that a retry overwrites; the feed is the
    checkpoint's, so a stream with a new checkpoint leaves earlier rows alone.
    """
    spark = lines.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        own = f"feed_id={_feed_id(spark, checkpoint)}/batch_id={batch_id}"
        parsed = parse_lines(batch, check_counts=True).persist()
        try:
            write_table(clean_posts(post_columns(parsed)), f"{posts_path}/{own}")
            write_table(reject_columns(parsed), f"{rejects_path}/{own}")
        finally:
            parsed.unpersist()

    return _foreach_batch(lines, handle, checkpoint, available_now)


def ingest_with_health(
    posts: DataFrame,
    tables: str,
    checkpoint: str,
    order: str = "ingest_seq",
    available_now: bool = True,
) -> StreamingQuery:
    """Exact dedupe against everything seen, and one health row per source run and micro-batch.

    ``posts`` are raw posts with ``source_name``, ``run_id`` and ``order``. Writes ``posts`` and ``ingest_batches``
    under ``tables``, each partitioned by ``feed_id`` and ``batch_id``, and the key history ``keys``; the feed is the
    checkpoint's. A batch meets the keys of all other feeds and of its own earlier batches, so a stream with
    a new checkpoint goes on where the tables end, and a retried batch overwrites its own partitions alone.
    ``batch_seq`` counts within a feed. Two feeds that run at once may both bring a key as new.
    """
    spark = posts.sparkSession
    history = KeyHistory(spark, f"{tables}/keys")

    def handle(batch: DataFrame, batch_id: int) -> None:
        feed = _feed_id(spark, checkpoint)
        keyed = with_record_key(batch).persist()
        try:
            _ingest(keyed, history, tables, feed, batch_id, order)
        finally:
            keyed.unpersist()

    return _foreach_batch(posts, handle, checkpoint, available_now)


def _own(feed: str, batch_id: int) -> str:
    return f"feed_id={feed}/batch_id={batch_id}"


def _ingest(keyed: DataFrame, history: KeyHistory, tables: str, feed: str, batch_id: int, order: str, table: str = "posts") -> DataFrame:
    """Write the batch's new posts, their keys and its health rows; give back the new posts as written."""
    spark, own = keyed.sparkSession, _own(feed, batch_id)
    history.merge(feed, batch_id)
    known = history.known(keyed, feed, batch_id)
    fresh = unseen_posts(keyed, keys_hit(known, keyed), order)
    write_table(fresh, f"{tables}/{table}/{own}")
    written = spark.read.schema(fresh.schema).parquet(f"{tables}/{table}/{own}")
    history.add(written, feed, batch_id)
    run = ["source_name", "run_id"]
    total = keyed.groupBy(*run).agg(F.count(F.lit(1)).alias("_seen"))
    new = written.groupBy(*run).agg(F.count(F.lit(1)).alias("_new"))
    new_records = F.coalesce(F.col("_new"), F.lit(0).cast("bigint"))
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"n.{c}")) for c in run]
    row = total.alias("t").join(new.alias("n"), same, "left").select(
        *(F.col(f"t.{c}").alias(c) for c in run),
        F.lit(batch_id).cast("bigint").alias("batch_seq"),
        F.current_timestamp().alias("batch_at"),
        new_records.alias("new_records"),
        (F.col("_seen") - new_records).alias("duplicates"),
    )
    write_table(row, f"{tables}/ingest_batches/{own}")
    return written


WATERMARKS = "feed_id string, batch_id bigint, highest timestamp"


def _watermark(spark: SparkSession, tables: str, feed: str, batch_id: int, delay: str) -> datetime | None:
    """The highest time of the feed's earlier batches less the delay: what Spark's own watermark would be in this batch."""
    try:
        seen = spark.read.schema(WATERMARKS).parquet(f"{tables}/watermarks")
    except AnalysisException:  # no batch has been here
        return None
    seen = seen.where((F.col("feed_id") == feed) & (F.col("batch_id") < batch_id))
    return seen.agg((F.max("highest") - F.expr(f"INTERVAL {delay}")).alias("at")).first().at


def ingest_lines(
    lines: DataFrame,
    tables: str,
    checkpoint: str,
    delay: str = DEFAULT_DELAY,
    every: str = "1h",
    as_of: datetime | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Lines of JSON to tables, none lost: each line is a reject, a duplicate, a late post or a post.

    ``rejects`` holds lines that are no posts and why. Posts seen before, in this or another feed, are duplicates,
    counted in ``ingest_batches``. New posts stand raw in ``new_posts``, and cleaned and scored in ``late``, with the
    watermark, if their time is behind it (the highest time of earlier batches less ``delay``), else in ``posts``.
    Undated posts are never late. Times after the batch's arrival do not move the watermark. ``bucket_parts`` holds each batch's sums, so
    ``live_buckets`` counts late posts like all others. Every table is partitioned by feed and batch, and a retried
    batch overwrites its own partitions. ``lines`` may carry ``source_name`` and ``run_id``; ages count from ``as_of``.
    """
    spark = lines.sparkSession
    history = KeyHistory(spark, f"{tables}/keys")
    carry = [c for c in ("source_name", "run_id") if c in lines.columns]

    def handle(batch: DataFrame, batch_id: int) -> None:
        feed = _feed_id(spark, checkpoint)
        own = _own(feed, batch_id)
        arrived = datetime.now(timezone.utc)
        behind = _watermark(spark, tables, feed, batch_id, delay)
        # Written once: its order is fixed then, and a line is parsed once for posts and rejects.
        write_table(parse_lines(batch, check_counts=True).withColumn("ingest_seq", F.monotonically_increasing_id()), f"{tables}/lines/{own}")
        parsed = spark.read.parquet(f"{tables}/lines/{own}")
        write_table(reject_columns(parsed, *carry), f"{tables}/rejects/{own}")
        posts = post_columns(parsed, "ingest_seq", *carry)
        for name in ("source_name", "run_id"):
            if name not in carry:
                posts = posts.withColumn(name, F.lit(None).cast("string"))
        written = _ingest(with_record_key(posts), history, tables, feed, batch_id, "ingest_seq", "new_posts")
        scored = add_signals(clean_posts(written, carry=("ingest_seq", "run_id")), as_of or arrived)
        is_late = F.lit(False) if behind is None else F.coalesce(F.col("timestamp") < F.lit(behind), F.lit(False))
        write_table(scored.where(~is_late), f"{tables}/posts/{own}")
        write_table(scored.where(is_late).withColumn("watermark", F.lit(behind).cast("timestamp")), f"{tables}/late/{own}")
        write_table(bucket_parts(scored, every), f"{tables}/bucket_parts/{own}")
        highest = scored.agg(F.max(F.when(F.col("timestamp") <= F.lit(arrived), F.col("timestamp"))).alias("highest"))
        write_table(highest, f"{tables}/watermarks/{own}")

    return _foreach_batch(lines, handle, checkpoint, available_now)


def live_buckets(spark: SparkSession, tables: str) -> DataFrame:
    """The buckets of all posts that ``ingest_lines`` has written so far."""
    return buckets_of_parts(spark.read.parquet(f"{tables}/bucket_parts"))
