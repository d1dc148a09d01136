"""Row selection: required values and the first rows in ingest order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsignal.operators.order import value_at_rank


def with_required_values(posts: DataFrame, columns: tuple[str, ...] = ("tweet_id", "content")) -> DataFrame:
    """Rows whose named columns are neither null nor empty."""
    for name in columns:
        posts = posts.where(F.col(name).isNotNull() & (F.col(name) != ""))
    return posts


def spread(frame: DataFrame, key: str, tasks_per_core: int = 2) -> DataFrame:
    """Hash a scan over all cores when its files make fewer splits than there are cores.

    Large inputs have more splits than that and come back as they are, without a shuffle.
    """
    tasks = frame.sparkSession.sparkContext.defaultParallelism * tasks_per_core
    if frame.rdd.getNumPartitions() >= tasks:
        return frame
    return frame.repartition(tasks, key)


def first_posts(posts: DataFrame, limit: int, order: str = "ingest_seq") -> DataFrame:
    """First ``limit`` rows in ingest order.

    The cut-off value is found from the order column alone and becomes a filter on the scan, so posts
    never gather anywhere. ``order`` must be unique: an integer, dense or not, or a struct of integers.
    Rows without an order value have no place and do not count among the first.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    if limit == 0:
        return posts.limit(0)
    cut = value_at_rank(posts, limit, order).first()
    if cut is None:  # fewer rows than the limit
        return posts.where(F.col(order).isNotNull())
    return posts.where(F.col(order) <= _literal(cut[0], posts.schema[order].dataType))


def _literal(value: object, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*(F.lit(value[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields))
    return F.lit(value).cast(kind)
