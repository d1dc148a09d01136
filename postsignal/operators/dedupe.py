"""First-wins duplicate removal: inside a frame, across batches, and counted per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postsignal.functions.scalars import cleaned_key, record_key, sha256_hex
from postsignal.operators.lookup import join_runs
from postsignal.operators.order import value_at_rank
from postsignal.operators.rows import with_required_values


def first_per_key(posts: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key by ``order``.

    Spark pushes the rank filter below the shuffle (one row per key and task crosses it), so a key
    that holds a large part of all rows does not gather in one task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return posts.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def with_cleaned_key(posts: DataFrame) -> DataFrame:
    key = cleaned_key(F.col("tweet_id"), F.col("content_clean"))
    return posts.withColumn("dedupe_key", sha256_hex(key))


def with_record_key(posts: DataFrame) -> DataFrame:
    key = record_key(F.col("tweet_id"), F.col("username"), F.col("content"))
    return posts.withColumn("dedupe_key", sha256_hex(key))


def dedupe_posts(posts: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """Cleaned posts without duplicates: the earliest row of each id, or of each text without id."""
    return first_per_key(with_cleaned_key(posts), "dedupe_key", order).drop("dedupe_key")


def unseen_posts(posts: DataFrame, seen: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """Raw posts whose key is neither in ``seen(dedupe_key)`` nor earlier in this batch.

    The batch is cut to one row per key first, so the join has no hot key. Keep the result's
    ``dedupe_key`` and append it to the key table once the rows are written.
    """
    if "dedupe_key" not in posts.columns:
        posts = with_record_key(posts)
    firsts = first_per_key(posts, "dedupe_key", order)
    return firsts.join(seen.select("dedupe_key"), "dedupe_key", "left_anti")


def keys_hit(seen: DataFrame, posts: DataFrame) -> DataFrame:
    """The part of a large key table that a batch with ``dedupe_key`` can meet.

    A batch that turns out small is broadcast to the key table, which then is read but not shuffled.
    """
    return seen.join(posts.select("dedupe_key"), "dedupe_key", "left_semi")


def append_seen_keys(new_posts: DataFrame, table: str, buckets: int) -> None:
    """Append keys to a table bucketed by key: later anti-joins then shuffle the batch alone."""
    (
        new_posts.select("dedupe_key")
        .write.mode("append")
        .bucketBy(buckets, "dedupe_key")
        .sortBy("dedupe_key")
        .saveAsTable(table)
    )


def seen_keys(spark: SparkSession, table: str) -> DataFrame:
    if spark.catalog.tableExists(table):
        return spark.table(table).select("dedupe_key")
    return spark.createDataFrame([], "dedupe_key string")


def _up_to(rows: DataFrame, place: Column, ends: DataFrame, run: tuple[str, ...]) -> DataFrame:
    """Rows up to the end of their run; runs without an end keep all."""
    if run:
        rows = join_runs(rows, ends, list(run), "left")
    else:
        rows = rows.withColumn("_end", ends.select("_end").scalar())
    return rows.where(F.col("_end").isNull() | (place <= F.col("_end"))).drop("_end")


def count_new_per_batch(
    posts: DataFrame,
    batch: str,
    position: str,
    run: tuple[str, ...] = (),
    limit: int | None = None,
) -> DataFrame:
    """New and repeated ids in each collection batch of each run.

    ``batch`` orders the batches of a run, ``position`` the rows of a batch. An id is new where it
    occurs first; rows without id or content are skipped. With ``limit``, a run ends at its
    ``limit``-th new id and later rows do not count; ``position`` must then be an integer, unique in
    its batch. Only counts and first places leave the map
    side: no window gathers all rows of an often repeated id.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    # Without a limit the batch alone decides, and a plain column keeps the aggregation hash-based.
    place = F.col(batch) if limit is None else F.struct(batch, position)
    rows = with_required_values(posts)
    firsts = rows.groupBy(*run, "tweet_id").agg(F.min(place).alias("_first"))
    if limit is not None:
        ends = value_at_rank(firsts, limit, "_first", run).withColumnRenamed("_first", "_end")
        firsts = _up_to(firsts, F.col("_first"), ends, run)
        rows = _up_to(rows, place, ends, run)
    seen = rows.groupBy(*run, batch).agg(F.count(F.lit(1)).alias("_seen"))
    first_batch = F.col("_first") if limit is None else F.col("_first").getField(batch)
    new = (
        firsts.select(*run, first_batch.alias(batch))
        .groupBy(*run, batch)
        .agg(F.count(F.lit(1)).alias("_new"))
    )
    new_records = F.coalesce(F.col("_new"), F.lit(0).cast("bigint"))
    return seen.join(new, [*run, batch], "left").select(
        *run, batch, new_records.alias("new_records"), (F.col("_seen") - new_records).alias("duplicates")
    )
