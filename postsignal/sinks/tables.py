"""Outputs: Parquet tables, JSON snapshots and row counters taken while writing."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsignal.schema import POST_FIELDS

# An ISO-8601 instant with its UTC offset, in microseconds.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: Posts in a file of a table by date, about.
ROWS_PER_FILE = 1_000_000


def shared_folder(spark: SparkSession, default: str) -> str:
    """Where intermediate tables go: the cluster's checkpoint folder, else ``default``."""
    return spark.conf.get("spark.checkpoint.dir", None) or default


def new_folder(spark: SparkSession, name: str, default: str | None = None) -> str:
    """A fresh folder for intermediate data that every executor reaches.

    ``default`` is used when the session names no checkpoint folder. Without either, a local session gets
    a temporary one and a cluster an error.
    """
    root = shared_folder(spark, default or "")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="postsignal-")
    return f"{root}/{name}_{uuid.uuid4().hex}"


def stage(frame: DataFrame, name: str, default: str | None = None) -> DataFrame:
    """Write a frame to a fresh folder and read it back.

    For frames with several readers: the work before is done once, each reader scans the columns it
    needs, and a lost executor costs a re-read.
    """
    spark = frame.sparkSession
    path = write_table(frame, new_folder(spark, name, default))
    return spark.read.schema(frame.schema).parquet(path)


def write_table(frame: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write a Parquet folder, replacing an earlier one, and return its path."""
    frame.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def with_event_date(posts: DataFrame) -> DataFrame:
    """Add the date to partition by, so that reads of a time range skip the other days."""
    return posts.withColumn("event_date", F.to_date("timestamp"))


def write_dated(posts: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> str:
    """Write posts partitioned by ``event_date``, a day in as few files as its rows need.

    Rows are dealt by day and by a salt below the day's number of files, so a hot day spreads over tasks and the
    others go into one each. The counts per day come from one aggregation of the time column.
    """
    dated = with_event_date(posts)
    days = dated.groupBy("event_date").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    met = dated.join(days.withColumnRenamed("event_date", "_day"), F.col("event_date").eqNullSafe(F.col("_day")))
    salt = F.pmod(F.xxhash64(*posts.columns), F.col("_files"))
    dealt = met.withColumn("_salt", salt).repartition("event_date", "_salt").drop("_day", "_files", "_salt")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("event_date").parquet(path)
    return path


def iso_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, ISO_FORMAT)


def post_documents(posts: DataFrame, *carry: str) -> DataFrame:
    """Raw posts as JSON documents with every field, null ones included."""
    fields = F.struct(*(F.col(name) for name in POST_FIELDS))
    return posts.select(*carry, F.to_json(fields, {"ignoreNullFields": "false"}).alias("document"))


def run_documents(runs: DataFrame) -> DataFrame:
    """Run envelopes as JSON documents; their posts are the documents of ``post_documents``."""
    fields = F.struct(
        "status",
        iso_text(F.col("started_at")).alias("started_at"),
        iso_text(F.col("ended_at")).alias("ended_at"),
        "error_message",
        "source_name",
        "n_records",
    )
    document = F.to_json(fields, {"ignoreNullFields": "false"})
    return runs.select("source_name", "run_id", document.alias("document"))


def write_snapshot(posts: DataFrame, metrics: DataFrame, path: str) -> str:
    """Save collected posts and the runs' metrics as JSON, for audit.

    ``posts`` (with ``source_name`` and ``run_id``) becomes one JSON line per post; ``summary`` one line per row of
    ``metrics`` (one per run) with the time and the number of the run's posts, counted from the written lines.
    """
    keys = ["source_name", "run_id"]
    post_documents(posts, *keys).write.mode("overwrite").json(f"{path}/posts")
    spark = posts.sparkSession
    counts = spark.read.schema("source_name string, run_id string").json(f"{path}/posts").groupBy(*keys).agg(F.count(F.lit(1)).alias("tweet_count"))
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    summary = metrics.alias("m").join(counts.alias("c"), same, "left").select(
        F.lit(datetime.now(timezone.utc).isoformat()).alias("written_at"),
        F.coalesce("c.tweet_count", F.lit(0).cast("bigint")).alias("tweet_count"),
        F.struct(*(F.col(f"m.{c}").alias(c) for c in metrics.columns)).alias("metrics"),
    )
    summary.write.mode("overwrite").json(f"{path}/summary")
    return path
